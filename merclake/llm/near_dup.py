"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is a ring of four segments of 16 bits. If two fingerprints differ in at most t bits, then from
some start on the ring every chain of l consecutive segments differs in at most l*t/4 bits (rounded down): for t = 3
nothing in the first segment, 1 bit in the first two, 2 in the first three. So for each of the four starts a
fingerprint sends its first two segments as a key, with every change its budget allows; two fingerprints meet where
one's own key is among the other's changed ones. The chain of three prunes what met, the full Hamming distance
decides. Where very many fingerprints meet under one key, the third segment joins the key, again with every change
its budget allows; then at most 2**16 own keys can meet.

Equal fingerprints are one node, so groups of exact copies cost nothing. What meets under one key is linked by a
spanning forest, not by all pairs. Components come from the links.

Defined results: a null or empty text, or one of white space, has fingerprint zero, which links like any other. Rows
that repeat a doc_id are rows of their own. A row without doc_id gets the component of its fingerprint's group, or
null if nobody there has an id. Without rows the result is empty. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, small_batches, store, text_bytes
from merclake.llm.components import components
from merclake.llm.registry import query

SEGMENTS, WIDTH = 4, 16
#: More rows than this under one key take a longer key.
CROWD = 4096
#: Up to so many rows under one key are compared pair by pair in one go.
FEW = 32
_LOW = [(np.uint64(1) << np.uint64(WIDTH * n)) - np.uint64(1) for n in range(SEGMENTS)]


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42, block: int = 1 << 15) -> int:
    """SimHash of a text: bit b is set if it is set in over half of the XXH64 hashes of its word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) for w in words]) + np.arange(len(words))
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, block):  # a long text needs no more memory than a block
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + block], stops[at : at + block])], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x, shingle) for x in text_bytes(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return run


def budgets(distance: int) -> list[int]:
    """Bits that the first 1, 2, ... segments of a chain may differ in."""
    return [(n + 1) * distance // SEGMENTS for n in range(SEGMENTS)]


def _flips(width: int, most: int) -> list[int]:
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)]


def changes(distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Changes of the first two segments within their budgets, and the bits each of them spends."""
    first, second = budgets(distance)[:2]
    masks = [a | b << WIDTH for a in _flips(WIDTH, first) for b in _flips(WIDTH, second) if (a | b << WIDTH).bit_count() <= second]
    return np.array(masks, dtype=np.uint64), np.array([m.bit_count() for m in masks], dtype=np.int32)


def _turned(prints: np.ndarray, start: int) -> np.ndarray:
    """The ring turned so that segment ``start`` is the lowest."""
    by = np.uint64(WIDTH * start)
    return prints if not start else (prints >> by) | (prints << (np.uint64(64) - by))


_ROWS = "key long, spent int, fp long, rep long"


def _keys(distance: int):
    """Every fingerprint under its own and its changed keys of two segments, for each start."""
    masks, spent = changes(distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            for start in range(SEGMENTS):
                own = _turned(prints, start) & _LOW[2]
                key = (own[:, None] ^ masks[None, :]) | np.uint64(start << 60)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.ravel().view(np.int64)), pa.array(np.tile(spent, len(prints))),
                        pa.array(np.repeat(prints.view(np.int64), len(masks))), pa.array(np.repeat(reps, len(masks))),
                    ],
                    ["key", "spent", "fp", "rep"],
                )

    return run


def _longer(key: np.ndarray, spent: np.ndarray, prints: np.ndarray, reps: np.ndarray, distance: int) -> tuple[np.ndarray, ...]:
    """The rows of a crowded key under keys of three segments."""
    most = budgets(distance)[2]
    start = int(key[0].view(np.uint64) >> np.uint64(60))
    outs = []
    for used in range(most + 1):
        own = spent == used
        masks = np.array(_flips(WIDTH, most - used), dtype=np.uint64)
        third = (_turned(prints[own], start) >> np.uint64(2 * WIDTH)) & _LOW[1]
        two = key[own].view(np.uint64) & _LOW[2]
        keys = two[:, None] | ((third[:, None] ^ masks[None, :]) << np.uint64(2 * WIDTH)) | np.uint64(start << 60)
        bits = np.bitwise_count(masks).astype(np.int32) + np.int32(used)
        outs.append((keys.ravel().view(np.int64), np.tile(bits, own.sum()), np.repeat(prints[own], len(masks)), np.repeat(reps[own], len(masks))))
    return tuple(np.concatenate(x) for x in zip(*outs))


def _few(runs: list[slice] | tuple, spent, prints, reps, start, distance) -> tuple[np.ndarray, np.ndarray]:
    """Links inside many small runs at once; own keys come first in a run."""
    begin, size, owns, turn = runs
    times = owns * size
    run = np.repeat(np.arange(len(begin)), times)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
    a, b = begin[run] + inner // size[run], begin[run] + inner % size[run]
    differ = prints[a] ^ prints[b]
    turned = np.where(turn[run] == 0, differ, (differ >> (turn[run] * np.uint64(WIDTH))) | (differ << ((np.uint64(64) - turn[run] * np.uint64(WIDTH)) & np.uint64(63))))
    chain = np.bitwise_count(turned & _LOW[3]) <= budgets(distance)[2]
    a, b, differ = a[chain], b[chain], differ[chain]
    near = (differ != 0) & (np.bitwise_count(differ) <= distance)
    return reps[a[near]], reps[b[near]]


def _many(owns: np.ndarray, own_reps: np.ndarray, prints: np.ndarray, reps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between own keys and all rows of one run."""
    label = np.arange(len(owns))
    left, right = [], []
    for p, rep in zip(prints, reps):
        near = np.flatnonzero(np.bitwise_count(owns ^ p) <= distance)
        if not len(near):
            continue
        left.append(rep)
        right.append(own_reps[near[0]])
        roots = np.unique(label[near])
        if len(roots) > 1:
            left += own_reps[roots[1:]].tolist()
            right += [own_reps[roots[0]]] * (len(roots) - 1)
            label[np.isin(label, roots[1:])] = roots[0]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _links(distance: int, crowd: int | None):
    """Rows sorted by key in; links (a, b) out, and the rows of keys over ``crowd`` under longer keys."""

    def batch(key, spent, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(spent, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["key", "spent", "fp", "rep"])

    def settle(key, spent, prints, reps) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((spent, key))
        key, spent, prints, reps = key[order], spent[order], prints[order], reps[order]
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((begin, [len(key)])))
        owns = np.add.reduceat((spent == 0).astype(np.int64), begin)
        live = (owns > 0) & (size > 1)
        small = live & (size <= FEW)
        turn = key[begin].view(np.uint64) >> np.uint64(60)
        found = [_few((begin[small], size[small], owns[small], turn[small]), spent, prints, reps, 0, distance)]
        for i in np.flatnonzero(live & (size > FEW)):
            s, n, m = begin[i], size[i], owns[i]
            found.append(_many(prints[s : s + m], reps[s : s + m], prints[s : s + n], reps[s : s + n], distance))
        a = np.concatenate([x for x, _ in found])
        b = np.concatenate([x for _, x in found])
        if len(a):
            pairs = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b))), axis=1)
            pairs = pairs[:, pairs[0] != pairs[1]]
            yield batch(np.zeros(pairs.shape[1], np.int64), np.full(pairs.shape[1], -1, np.int32), pairs[0], pairs[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        crowded: int | None = None
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "spent", "fp", "rep")]
            cols[2] = cols[2].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
                held = None
            if not len(cols[0]):
                continue
            if crowded is not None:  # the rest of a crowded key
                n = int(np.searchsorted(cols[0], crowded, "right"))
                if n:
                    keys, bits, prints, reps = _longer(*(x[:n] for x in cols), distance)
                    yield batch(keys, bits, prints.view(np.int64), reps)
                cols = [x[n:] for x in cols]
                if not len(cols[0]):
                    continue
                crowded = None
            last = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            if last:
                yield from settle(*(x[:last] for x in cols))
            held = [x[last:] for x in cols]
            if crowd is not None and len(held[0]) > crowd:
                crowded = int(held[0][0])
                keys, bits, prints, reps = _longer(*held, distance)
                yield batch(keys, bits, prints.view(np.int64), reps)
                held = None
        if held is not None and len(held[0]):
            yield from settle(*held)

    return run


def links(nodes: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between the ``rep`` of distinct fingerprints ``fp``: within the distance, and enough of them
    to connect all that are."""
    if not 0 <= distance < 2 * SEGMENTS:
        raise ValueError("distance must be 0 to 7")
    keyed = nodes.select("fp", "rep").mapInArrow(_keys(distance), _ROWS)
    first = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links(distance, crowd), _ROWS)
    first = store(first, "links")
    edges = first.where("spent < 0")
    rest = first.where("spent >= 0")
    if not rest.isEmpty():
        again = rest.repartition("key").sortWithinPartitions("key").mapInArrow(_links(distance, None), _ROWS)
        edges = edges.union(again)
    return edges.select(F.col("fp").alias("a"), F.col("rep").alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and component_id, the smallest doc_id that chains of links reach."""
    small_batches(docs.sparkSession)
    prints = store(docs.select("doc_id", "text").mapInArrow(_fingerprints(shingle), "doc_id long, fp long"), "fingerprints")
    # fingerprints are linked, whether or not a document that has one has an id
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp", F.col("fp").alias("rep")), distance))
    placed = store(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "placed")
    named = placed.select("fp", "root").join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return prints.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


@query("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")
