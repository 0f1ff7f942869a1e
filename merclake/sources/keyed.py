"""Keyed tables of a ledger: insert what is new, merge by bucket, with an index of the keys.

A row lies in the bucket of its key's hash. Next to the rows the ledger holds an index, a blocked Bloom filter: a key sets
eight bits of one block of 256 bits, four long integers. Blocks are rows of a table, built by ``bit_or`` and looked up by
a join, so building, adding and probing are plain aggregations and joins at any size, and nothing is gathered on the
driver. About two bytes a key are read to learn that a key is new; only the buckets of possible hits, one in some
hundred keys by chance, have their key columns read for an exact check.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from merclake.functions.sequence import first_per_key
from merclake.session import materialize
from merclake.sources.ledger import Change, Ledger, State, bucket_of
from merclake.sources.writers import upsert

#: Keys that fill a block (16 bits each), bits that a key sets, long integers of a block.
FULL, BITS, WORDS = 16, 8, 4


@dataclass(frozen=True)
class Keyed:
    """A table by key. ``buckets`` and ``blocks`` (of the index, in each bucket) are fixed when it gets its first rows;
    the index is laid out anew, with more blocks, when its keys outgrow it."""

    table: str
    keys: tuple[str, ...]
    buckets: int = 64
    blocks: int = 64

    @property
    def index(self) -> str:
        return f"{self.table}_keys"

    def sizes(self, state: State) -> dict[str, int]:
        return state.notes.get(self.index) or {"buckets": self.buckets, "blocks": self.blocks, "keys": 0}


def _bits(keys: list[str], blocks: int) -> list[Column]:
    """The block of a key and the bits it sets there, one mask per long integer."""
    block = F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    spread = F.xxhash64(*keys, F.lit(2))
    places = [F.shiftrightunsigned(spread, 8 * i).bitwiseAND(255) for i in range(BITS)]
    one = F.lit(1).cast("bigint")
    masks = []
    for w in range(WORDS):
        bits = [F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", one, p.bitwiseAND(63).cast("int"))).otherwise(F.lit(0).cast("bigint")) for p in places]
        masks.append(reduce(Column.bitwiseOR, bits).alias(f"w{w}"))
    return [block, *masks]


def _blocks(rows: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """The index of some rows: bucket, block, w0 to w3."""
    return rows.select("bucket", *_bits(keys, blocks)).groupBy("bucket", "block").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def _touched(rows: DataFrame) -> list[int]:
    """The buckets of a batch, no more than the table has."""
    return sorted(r[0] for r in rows.select("bucket").distinct().collect())


def possible(ledger: Ledger, state: State, spec: Keyed, batch: DataFrame, buckets: list[int]) -> DataFrame:
    """The rows of a batch (with ``bucket``) whose key may be stored. A row that is left out is certainly new."""
    keys, size = list(spec.keys), spec.sizes(state)
    index = ledger.read(spec.index, "block int, w0 long, w1 long, w2 long, w3 long, bucket int", state, buckets)
    merged = index.groupBy("bucket", "block").agg(*[F.bit_or(f"w{w}").alias(f"_i{w}") for w in range(WORDS)])
    asked = batch.select("*", *_bits(keys, size["blocks"]))
    found = asked.join(merged, ["bucket", "block"])
    return found.where(reduce(and_, [F.col(f"_i{w}").bitwiseAND(F.col(f"w{w}")) == F.col(f"w{w}") for w in range(WORDS)])).select(*batch.columns)


def _written(ledger: Ledger, state: State, spec: Keyed, rows: DataFrame, new: DataFrame, drop: list[str] | None = None) -> Change:
    """Write stored rows, and the index of those whose key is new."""
    size = spec.sizes(state)
    change = ledger.write(spec.table, rows, by_bucket=True)
    change.drop = {spec.table: drop or []}
    change = change.also(ledger.write(spec.index, _blocks(new, list(spec.keys), size["blocks"]), by_bucket=True))
    return change.also(Change(notes={spec.index: size | {"keys": size["keys"] + new.count()}}))


def regrow(ledger: Ledger, state: State, spec: Keyed) -> State:
    """Lay the index out with as many blocks as its keys need, from the key columns, and commit that."""
    size = spec.sizes(state)
    blocks = max(size["blocks"], 2 * -(-size["keys"] // (FULL * size["buckets"])))
    rows = ledger.read(spec.table, state=state).select("bucket", *spec.keys)
    change = ledger.write(spec.index, _blocks(rows, list(spec.keys), blocks), by_bucket=True)
    change.drop = {spec.index: state.tables.get(spec.index, [])}
    return ledger.commit(state, change.also(Change(notes={spec.index: size | {"blocks": blocks}})))


def outgrown(state: State, spec: Keyed) -> bool:
    size = spec.sizes(state)
    return size["keys"] > FULL * size["buckets"] * size["blocks"]


def insert_new(ledger: Ledger, state: State, spec: Keyed, batch: DataFrame, order_by: list[Column] | None = None) -> tuple[Change, DataFrame]:
    """The change that adds the rows of a batch whose key the table lacks, one per key, and these rows. A row with a NULL
    in its key equals no other and is added."""
    keys, buckets = list(spec.keys), spec.sizes(state)["buckets"]
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    single = first_per_key(batch.where(whole), keys, order_by or []).unionByName(batch.where(~whole))
    rows = materialize(single.withColumn("bucket", bucket_of(keys, buckets)))
    touched = _touched(rows)
    hits = materialize(possible(ledger, state, spec, rows.select(*keys, "bucket"), touched))
    doubtful = _touched(hits)
    fresh = rows
    if doubtful:
        known = ledger.read(spec.table, rows.schema, state, doubtful).select("bucket", *keys)
        fresh = materialize(rows.join(hits.join(known, ["bucket", *keys], "left_semi"), ["bucket", *keys], "left_anti").select(*rows.columns))
    return _written(ledger, state, spec, fresh, fresh.where(whole)), fresh.drop("bucket")


def merge(ledger: Ledger, state: State, spec: Keyed, batch: DataFrame, update_columns: list[str], newest: str | None = None) -> tuple[Change, list[int]]:
    """The change that upserts a batch, and the buckets it rewrites; the files of all others stay as they are, also where
    a row changes its day. A bucket's folders become one."""
    keys, buckets = list(spec.keys), spec.sizes(state)["buckets"]
    rows = materialize(batch.withColumn("bucket", bucket_of(keys, buckets)))
    touched = _touched(rows)
    stored = ledger.read(spec.table, rows.schema, state, touched)
    merged = materialize(upsert(stored.withColumn("_stored", F.lit(True)), rows, ["bucket", *keys], update_columns, newest))
    new = merged.where("_stored IS NULL").select("bucket", *keys)
    old = ledger.folders(spec.table, state, touched)
    return _written(ledger, state, spec, merged.drop("_stored"), new, old), touched
