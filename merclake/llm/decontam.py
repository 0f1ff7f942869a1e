"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive tokens that ignores the positions marked 0, so a substituted word there
leaves its hash unchanged. Every overlap of ``least`` = 12 or more tokens of which 80 % agree holds a hit of one of the
three masks, wherever the substitutions fall. Test and training hashes are joined; around every hit the two texts are
laid on each other at the hit's offset and the best run of tokens decides.

Training hashes that no test text can have are left out before the join by a bitmap of a fixed size, two bits for a
hash; it only spares work and may let any through. Hits of one document that lie close together share one region of its tokens, so a
copied passage is carried once.

Tokens are runs of digits, letters a-z (A-Z lower-cased) and all characters beyond ASCII.

Defined results: null and empty texts have no tokens. A test text shorter than ``least`` tokens must agree over its
whole length, one shorter than ``shortest`` is no evidence and finds nothing. Rows that repeat a doc_id are reported once
for an item, a null doc_id like any other; a null item_id is an item. Empty tables give an empty result. Further columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, grouped, chunk, scramble, small_batches, store, text_bytes
from merclake.llm.registry import query

#: Fixed masks. With them every run of 12 to 25 tokens with 80 % agreement holds a hit.
MASKS = ("1111011", "110010111", "11000100111")
#: Tokens kept on either side of a hit: more than a shortest overlap that can decide.
AROUND = 32
#: Bits of the bitmap of test hashes: 1 MiB.
BITS = 1 << 23
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")


def tokens(text: bytes) -> list[bytes]:
    return _TOKEN.findall(text.lower())


def token_ids(words: list[bytes]) -> np.ndarray:
    """A 64-bit number for each token, never 0."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words)) | np.uint64(1)


def offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


def seed_hashes(ids: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The mask's hash at every position where it fits."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(number + 1))
    for i in offsets(mask):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += ids[i : i + n]
    return scramble(out)


def _masks(shortest: int, least: int) -> list[str]:
    """The fixed masks, and for each length of a test text below ``least`` a mask that ignores nothing."""
    return [*MASKS, *("1" * n for n in range(shortest, least))]


def _test_seeds(masks: list[str], shortest: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for nth, text in zip(batch.column("nth").to_pylist(), text_bytes(batch.column("text"))):
                ids = token_ids(tokens(text))
                if len(ids) < shortest:
                    continue
                for number, mask in enumerate(masks):
                    if len(ids) >= least if number < len(MASKS) else len(mask) == len(ids):
                        found = seed_hashes(ids, mask, number)
                        out.append((found.view(np.int64), np.full(len(found), nth, np.int64), np.arange(len(found), dtype=np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["hash", "nth", "at"])

    return run


def _is_set(bitmap: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _regions(masks: list[str], bitmap: np.ndarray, around: int):
    """Documents in; one row for each region with hits out: its tokens, where it begins, and the hits."""
    longest = max(len(m) for m in masks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 1 << 20):
            doc_ids = table.column("doc_id").to_pylist()
            words = [tokens(x) for x in text_bytes(chunk(table, "text"))]
            sizes = np.array([len(w) for w in words])
            # texts follow each other with a gap that no seed bridges
            ids = np.zeros(int(sizes.sum()) + longest * len(words), dtype=np.uint64)
            begins = np.cumsum(sizes + longest) - (sizes + longest)
            of = np.repeat(np.arange(len(words)), sizes)
            place = np.arange(len(of)) + of * longest
            ids[place] = token_ids([w for own in words for w in own])
            whole = np.cumsum(np.concatenate(([0], (ids != 0).astype(np.int64))))
            positions, hashes = [], []
            for number, mask in enumerate(masks):
                found = seed_hashes(ids, mask, number)
                hit = np.flatnonzero(_is_set(bitmap, found & np.uint64(BITS - 1)))
                hit = hit[_is_set(bitmap, found[hit] >> np.uint64(32) & np.uint64(BITS - 1))]
                hit = hit[whole[hit + len(mask)] - whole[hit] == len(mask)]
                positions.append(hit)
                hashes.append(found[hit])
            at, found = np.concatenate(positions), np.concatenate(hashes)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, found = at[order], found[order]
            doc = np.searchsorted(begins, at, "right") - 1
            far = np.concatenate(([True], (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 2 * around)))
            cuts = np.flatnonzero(far)
            rows = []
            for a, b in zip(cuts, np.append(cuts[1:], len(at))):
                d = int(doc[a])
                lo = max(int(begins[d]), int(at[a]) - around)
                hi = min(int(begins[d] + sizes[d]), int(at[b - 1]) + longest + around)
                own = ids[lo:hi]
                start = lo - int(begins[d])
                key = xxhash.xxh64_intdigest(own.tobytes(), start)
                hits = [{"hash": int(h), "pos": int(p)} for h, p in zip(found[a:b].view(np.int64), at[a:b] - begins[d])]
                rows.append((doc_ids[d], int(np.uint64(key).view(np.int64)), start, own.view(np.int64), hits))
            for i in range(0, len(rows), 500):
                cols = list(zip(*rows[i : i + 500]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                        pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int64())]))),
                    ],
                    ["doc_id", "region", "start", "ids", "hits"],
                )

    return run


def best_run(agree: np.ndarray, least: int, percent: int) -> tuple[int, int, int] | None:
    """Start, length and number of agreeing tokens of the best run of at least ``least`` tokens of which ``percent``
    or more agree, the first of equals; None if there is none. A run's worth falls below 0 where too few agree."""
    if len(agree) < least or not least:
        return None
    worth = np.where(agree, 100 - percent, -percent)
    sums = np.concatenate(([0], np.cumsum(worth)))
    lowest = np.minimum.accumulate(sums[: len(sums) - least])
    gain = sums[least:] - lowest
    end = int(np.argmax(gain))
    if gain[end] < 0:
        return None
    start = int(np.argmax(sums[: end + 1] == lowest[end]))
    return start, end + least - start, int(agree[start : end + least].sum())


def _verify(least: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked, out = [], []
            cols = [batch.column(c).to_pylist() for c in ("start", "offset")]
            texts = [batch.column(c) for c in ("ids", "item")]
            for i, (start, offset) in enumerate(zip(*cols)):
                own, item = (t[i].values.to_numpy(zero_copy_only=False) for t in texts)
                first = start - offset  # where the region begins in the item
                a, b = max(0, first), min(len(item), first + len(own))
                if a >= b:
                    continue
                run_ = best_run(own[a - first : b - first] == item[a:b], min(least, len(item)), percent if len(item) >= least else 100)
                if run_:
                    picked.append(i)
                    out.append((a + run_[0] + offset, a + run_[0], run_[1], run_[2]))
            if picked:
                keys = [batch.column(c).take(pa.array(picked)) for c in ("doc_id", "item_id")]
                yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x, pa.int64()) for x in zip(*out))], ["doc_id", "item_id", "doc_start", "item_start", "n_tokens", "n_agree"])

    return run


def _item_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [token_ids(tokens(x)).view(np.int64) for x in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("nth"), batch.column("item_id"), pa.array(ids, pa.list_(pa.int64()))], ["nth", "item_id", "item"])


def overlaps(docs: DataFrame, tests: DataFrame, least: int = 12, percent: int = 80, shortest: int = 5) -> DataFrame:
    """One row for each document and test text that overlap: doc_id, item_id, and the best run of agreeing tokens:
    doc_start, item_start, n_tokens, n_agree, similarity. ``docs`` has doc_id and text, ``tests`` item_id and text.
    The masks miss nothing from 12 tokens and 80 percent on."""
    if least < 12 or percent < 80:
        raise ValueError("the masks need overlaps of at least 12 tokens and 80 percent")
    spark = small_batches(docs.sparkSession)
    masks = _masks(shortest, least)
    items = tests.select(F.xxhash64("item_id", "text").alias("nth"), F.col("item_id").cast("long"), "text")
    seeds = store(items.select("nth", "text").mapInArrow(_test_seeds(masks, shortest, least), "hash long, nth long, at long").distinct(), "seeds")
    pick = lambda h: h.bitwiseAND(F.lit(BITS - 1))
    bits = seeds.select(F.explode(F.array(pick(F.col("hash")), pick(F.shiftright("hash", 32)))).alias("bit"))
    bytes_ = bits.groupBy(F.shiftright("bit", 3).cast("int").alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(bit & 7 as int))")).alias("bits"))
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    for row in bytes_.toLocalIterator():  # at most as many rows as the bitmap has bytes
        bitmap[row["byte"]] = row["bits"]
    sent = spark.sparkContext.broadcast(bitmap)
    kind = "doc_id long, region long, start long, ids array<bigint>, hits array<struct<hash:bigint,pos:bigint>>"
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _regions(masks, sent.value, AROUND)(batches)

    regions = store(rows.mapInArrow(find, kind), "regions")
    hits = regions.select("doc_id", "region", F.explode("hits").alias("h")).select("doc_id", "region", "h.hash", "h.pos")
    meets = hits.join(seeds, "hash").select("doc_id", "region", "nth", (F.col("pos") - F.col("at")).alias("offset")).distinct()
    items = items.mapInArrow(_item_ids, "nth long, item_id long, item array<bigint>").dropDuplicates(["nth"])
    meets = meets.withColumnRenamed("doc_id", "d").withColumnRenamed("region", "r")
    laid = meets.join(regions.drop("hits"), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("r") == F.col("region")))
    laid = laid.join(items, "nth").select("doc_id", "item_id", "start", "offset", "ids", "item")
    found = laid.mapInArrow(_verify(least, percent), "doc_id long, item_id long, doc_start long, item_start long, n_tokens long, n_agree long")
    worth = F.col("n_agree") * 100 - F.col("n_tokens") * percent
    best = found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(worth.alias("w"), (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"), "n_tokens", "n_agree")).alias("b")
    )
    return best.select(
        "doc_id", "item_id", (-F.col("b.d")).alias("doc_start"), (-F.col("b.i")).alias("item_start"), "b.n_tokens", "b.n_agree",
        (F.col("b.n_agree") / F.col("b.n_tokens")).alias("similarity"),
    )


def clean(docs: DataFrame, tests: DataFrame, **how) -> DataFrame:
    """The documents that overlap with no test text."""
    found = store(overlaps(docs, tests, **how).select(F.col("doc_id").alias("_found")).distinct(), "found")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("_found")), "left_anti")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
