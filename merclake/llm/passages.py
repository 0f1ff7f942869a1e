"""Removal of repeated passages by prefix-partitioned suffix trees over words.

A word goes if ``words`` consecutive words that cover it also start in a document with a smaller doc_id. The suffixes of
all texts are split into groups by a prefix, each group is small enough for one task's memory, and the deep inner nodes
of its tree, those at ``words`` words or more, are the repeats.

* *Sparse suffixes.* Every string of ``words`` words has one anchor: the leftmost place whose next ``PREFIX`` words have
  the least hash. Equal strings have equal anchors, so only suffixes at anchors are indexed, about two in eleven. A
  suffix carries the words before it too, as far as its strings reach.
* *Prefix census.* Suffixes are counted by their first ``PREFIX`` words. A prefix that stands in one document only
  has no inner node between documents and drops out before any text is moved.
* *Subtrees.* A group is sorted by the words from the anchor on; the common lengths of neighbours give the tree's nodes
  at every depth. Sorted by the words before the anchor, they give the same to the left. Suffixes that share the node
  of depth ``words - j`` and the left node of depth j share the string that starts j words before the anchor: a maximal
  repeat spans what both trees share. The smallest doc_id of the shared node keeps it, the others lose it.
* *Variable length.* A prefix with more than ``crowd`` suffixes is made longer, up to all that a suffix carries, where a
  group is a single text whose smallest doc_id Spark finds by a combinable minimum; no task has to hold the group.
  Whoever else has that text loses it. What the first document shares with still other texts is found from its strings,
  again by a minimum per string.

Words are compared by 48 bits of their hash each, texts of a crowded prefix by 128 bits.

Defined results: a null text has no words. A row without doc_id keeps all its words and gives no reason to remove any.
Rows that repeat a doc_id never remove words from each other; they may have different texts. Strings never span two
documents. Without rows the result is empty. Further columns are not read, but ``keep`` carries them along.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, grouped, scramble, small_batches, store, text_bytes
from merclake.llm.registry import query

#: Words of the shortest prefix.
PREFIX = 4
#: Bytes of a word's hash that a suffix carries.
NAME = 6
#: Words of one text that are laid out at once, bytes of text looked at together, and suffixes settled together.
BLOCK, TEXT, ROWS = 1 << 20, 8 << 20, 1 << 15
#: Multiplier of the hash of a prefix. Any large odd number does.
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = b" \t\n\r\x0b\x0c"


class Names(dict):
    """64-bit hashes of words, remembered while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        name = self[word] = xxhash.xxh64_intdigest(word)
        return name

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 1 << 20:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_up(text: bytes, size: int = 8 << 20) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes at a time."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[at:end].split()
        at = end
    yield (text[at:] if at else text).split()


def blocks_of(texts: list[bytes], words: int) -> Iterator[tuple[list[int], list[int], list[list[bytes]]]]:
    """Texts as lists of words, laid out together: the text each list is of, the place where it begins, the words. A
    long text comes in several lists; each begins with the last ``words - 1`` words of the one before."""
    owner: list[int] = []
    first: list[int] = []
    lists: list[list[bytes]] = []
    held = 0
    for i, text in enumerate(texts):
        at, tail = 0, []
        for part in split_up(text):
            part = tail + part
            if len(part) >= words:
                owner.append(i)
                first.append(at)
                lists.append(part)
                held += len(part)
            tail = part[-(words - 1) :] if words > 1 else []
            at += len(part) - len(tail)
            if held > BLOCK:
                yield owner, first, lists
                owner, first, lists, held = [], [], [], 0
    if lists:
        yield owner, first, lists


def string_hash(names: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words from every place on; the last places mean nothing."""
    out = np.zeros(len(names), dtype=np.uint64)
    for j in range(length):
        out *= BASE
        out[: len(names) - j] += names[j:]
    return scramble(out)


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every place the leftmost place of the least value among ``width``; the last places mean nothing."""
    n = len(values)
    best = np.arange(n)

    def joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        out = left.copy()
        a, b = left[: n - shift], right[shift:]
        out[: n - shift] = np.where(values[b] < values[a], b, a)
        return out

    powers = [best]  # powers[i]: over 2**i places
    while 2 << (len(powers) - 1) <= width:
        powers.append(joined(powers[-1], powers[-1], 1 << (len(powers) - 1)))
    span = 1 << (len(powers) - 1)
    return powers[-1] if span == width else joined(powers[-1], powers[-1], width - span)


class Runs:
    """The strings of a block of texts, as runs of neighbours with one anchor."""

    def __init__(self, lists: list[list[bytes]], words: int, names: Names):
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.names = names.of(list(chain.from_iterable(lists)))
        n = len(self.names)
        self.hashes = string_hash(self.names, PREFIX)
        anchors = leftmost_least(self.hashes, words - PREFIX + 1)
        end = np.repeat(self.begin + sizes, sizes)
        live = np.flatnonzero(np.arange(n) + words <= end)
        anchors = anchors[live]
        new = np.ones(len(live), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (live[1:] != live[:-1] + 1)
        at = np.flatnonzero(new)
        #: Of every run: its first string, the number of strings, the anchor, the list.
        self.start = live[at]
        self.count = np.diff(np.append(at, len(live)))
        self.anchor = anchors[at]
        self.owner = np.searchsorted(self.begin, self.start, side="right") - 1


def _anchors(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for table in grouped(batches, TEXT):
            ids = table.column("doc_id").to_numpy()
            rows = table.column("row").to_numpy()
            for owner, first, lists in blocks_of(text_bytes(table.column("text")), words):
                runs = Runs(lists, words, names)
                doc = np.array(owner)[runs.owner]
                place = runs.anchor - runs.begin[runs.owner] + np.array(first)[runs.owner]
                yield pa.RecordBatch.from_arrays([pa.array(runs.hashes[runs.anchor].view(np.int64)), pa.array(ids[doc]), pa.array(rows[doc]), pa.array(place)], ["prefix", "doc_id", "row", "place"])

    return run


_SUFFIX = "prefix long, doc_id long, row long, start long, before int, strings int, names binary"


def _picked(words: int, each: bool):
    """Of the runs whose anchors were picked, the suffixes with their words, or digests of all they carry and of each string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for table in grouped(batches, TEXT):
            ids = table.column("doc_id").to_numpy()
            rows = table.column("row").to_numpy()
            picks = [np.sort(x) for x in table.column("picks").to_pandas()]
            for owner, first, lists in blocks_of(text_bytes(table.column("text")), words):
                runs = Runs(lists, words, names)
                base = np.array(first)[runs.owner] - runs.begin[runs.owner]
                place = runs.anchor + base
                keep = np.zeros(len(place), dtype=bool)
                for k in range(len(lists)):  # runs are in order of their lists
                    a, b = np.searchsorted(runs.owner, [k, k + 1])
                    wanted = picks[owner[k]]
                    found = np.searchsorted(wanted, place[a:b])
                    keep[a:b] = wanted[np.minimum(found, len(wanted) - 1)] == place[a:b]
                kept = np.flatnonzero(keep)
                doc = np.array(owner)[runs.owner[kept]]
                start, count = runs.start[kept], runs.count[kept]
                if each:
                    data = runs.names.tobytes()
                    digest = lambda a, b: xxhash.xxh128_digest(data[8 * a : 8 * b])
                    whole = [digest(a, a + n + words - 1) for a, n in zip(start.tolist(), count.tolist())]
                    strings = [digest(i, i + words) for a, n in zip(start.tolist(), count.tolist()) for i in range(a, a + n)]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(strings, pa.binary()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(whole, pa.binary()), pa.array(ids[doc]), pa.array(rows[doc]), pa.array(start + base[kept]), lists], ["whole", "doc_id", "row", "start", "strings"]
                    )
                    continue
                data = runs.names.view(np.uint8).reshape(-1, 8)[:, :NAME].tobytes()
                cut = [data[a:b] for a, b in zip((start * NAME).tolist(), ((start + count + words - 1) * NAME).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(runs.hashes[runs.anchor[kept]].view(np.int64)), pa.array(ids[doc]), pa.array(rows[doc]), pa.array(start + base[kept]),
                        pa.array((runs.anchor[kept] - start).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(cut, pa.binary()),
                    ],
                    ["prefix", "doc_id", "row", "start", "before", "strings", "names"],
                )

    return run


def _nodes(columns: list[np.ndarray], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tree over rows of a group by the given columns: the order of its leaves, and the length that each leaf has in
    common with the one before; -1 where a group begins."""
    order = np.lexsort([*columns[::-1], group])
    common = np.full(len(order), len(columns), dtype=np.int64)
    for depth in range(len(columns) - 1, -1, -1):
        c = columns[depth][order]
        common[1:][c[1:] != c[:-1]] = depth
    g = group[order]
    common[1:][g[1:] != g[:-1]] = -1
    common[0] = -1
    return order, common


def repeated(group: np.ndarray, doc: np.ndarray, before: np.ndarray, strings: np.ndarray, names: np.ndarray, size: np.ndarray, words: int) -> np.ndarray:
    """For every suffix and string of its run (columns) whether it also starts in a smaller document of its group.
    ``names`` holds the words of all runs one after another, ``size`` of them each."""
    n = len(group)
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    anchor = at + before
    padded = np.append(names, np.uint64(0))

    def word(place: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return padded[np.where(inside, place, len(names))]

    right = [word(anchor + d, before + d < size) for d in range(words)]
    left = [word(anchor - d, before >= d) for d in range(1, words - PREFIX + 1)]
    right_order, right_common = _nodes(right, group)
    left_order, left_common = _nodes(left, group)
    out = np.zeros((n, words - PREFIX + 1), dtype=bool)
    for j in range(words - PREFIX + 1):
        own = np.flatnonzero((j <= before) & (j > before - strings))
        if not len(own):
            continue
        node, behind = np.empty(n, np.int64), np.empty(n, np.int64)
        node[right_order] = np.cumsum(right_common < words - j)  # nodes of depth words - j
        behind[left_order] = np.cumsum(left_common < j)
        key = node[own] * (n + 1) + behind[own]
        order = np.lexsort((doc[own], key))
        sorted_key, sorted_doc = key[order], doc[own][order]
        first = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1]))
        least = np.repeat(sorted_doc[first], np.diff(np.append(first, len(own))))
        out[own[order], before[own[order]] - j] = sorted_doc > least
    return out


def _settled(words: int):
    """Suffixes sorted by prefix in; spans of repeated words out."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        cells = table.column("names").combine_chunks()
        cells = cells.chunk(0) if isinstance(cells, pa.ChunkedArray) else cells
        offsets = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64)
        data = np.frombuffer(cells.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, NAME)
        wide = np.zeros((len(data), 8), np.uint8)
        wide[:, :NAME] = data
        col = {c: table.column(c).to_numpy() for c in ("prefix", "doc_id", "row", "start", "before", "strings")}
        before, strings = col["before"].astype(np.int64), col["strings"].astype(np.int64)
        gone = repeated(col["prefix"], col["doc_id"], before, strings, wide.view(np.uint64).ravel(), np.diff(offsets) // NAME, words)
        edge = np.zeros((len(gone), 1), dtype=bool)
        framed = np.hstack((edge, gone, edge))
        row, a = np.nonzero(framed[:, 1:] & ~framed[:, :-1])
        _, b = np.nonzero(framed[:, :-1] & ~framed[:, 1:])
        start = col["start"][row]
        return pa.RecordBatch.from_arrays([pa.array(col["doc_id"][row]), pa.array(col["row"][row]), pa.array(start + a), pa.array(start + b + words - 1)], ["doc_id", "row", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows < ROWS:
                continue
            prefix = held.column("prefix").to_numpy()
            at = int(np.searchsorted(prefix, prefix[-1]))  # the last group may go on in the next batch
            if at:
                yield settle(held.slice(0, at).combine_chunks())
                held = held.slice(at).combine_chunks()
        if held is not None and held.num_rows:
            yield settle(held.combine_chunks())

    return run


def forget(df: DataFrame) -> None:
    """Delete a stored frame that nothing reads any more."""
    files = df.inputFiles()
    if files:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(os.path.dirname(files[0]))
        place.getFileSystem(conf).delete(place, True)


def spans(docs: DataFrame, words: int = 13, crowd: int = 1000) -> DataFrame:
    """doc_id, row, a, b: words a to b (exclusive, from 0) of a text go. ``row`` is a hash of the text, for rows that
    repeat a doc_id. Spans may overlap."""
    if words < PREFIX:
        raise ValueError(f"passages have at least {PREFIX} words")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    anchors = store(texts.mapInArrow(_anchors(words), "prefix long, doc_id long, row long, place long"), "anchors")
    counted = anchors.groupBy("prefix").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    # stored, so that both sides of a join are plain shuffles and Spark can split a frequent prefix
    census = store(counted.where("lo < hi").select("prefix", (F.col("n") > crowd).alias("crowded")), "prefixes")
    shared = anchors.join(census.hint("shuffle_hash"), "prefix")
    picks = store(
        shared.groupBy("doc_id", "row").agg(
            F.collect_list(F.when(~F.col("crowded"), F.col("place"))).alias("picks"), F.collect_list(F.when(F.col("crowded"), F.col("place"))).alias("crowds")
        ), "picks")
    forget(anchors)

    def chosen(column: str) -> DataFrame:
        own = picks.where(F.size(column) > 0).select("doc_id", "row", F.col(column).alias("picks"))
        return texts.join(own, ["doc_id", "row"]).select("doc_id", "row", "text", "picks")

    suffixes = chosen("picks").mapInArrow(_picked(words, False), _SUFFIX).repartition("prefix").sortWithinPartitions("prefix")
    found = store(suffixes.mapInArrow(_settled(words), "doc_id long, row long, a long, b long"), "spans")
    crowded = store(chosen("crowds").mapInArrow(_picked(words, True), "whole binary, doc_id long, row long, start long, strings array<binary>"), "crowded")
    known = crowded.join(_least(crowded, "whole").hint("shuffle_hash"), "whole")
    again = known.where("doc_id > least").select("doc_id", "row", F.col("start").alias("a"), (F.col("start") + F.size("strings") + words - 1).alias("b"))
    first = known.where("doc_id = least").select("doc_id", "row", "start", F.posexplode("strings").alias("at", "string"))
    first = store(first.select("doc_id", "row", (F.col("start") + F.col("at")).alias("a"), "string"), "strings")
    least = _least(first, "string").where("least < most")
    also = first.join(least.hint("shuffle_hash"), "string").where("doc_id > least").select("doc_id", "row", "a", (F.col("a") + words).alias("b"))
    return found.unionByName(again).unionByName(also)


def _least(rows: DataFrame, key: str) -> DataFrame:
    """The smallest and largest doc_id of every key, set aside."""
    return store(rows.groupBy(key).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "least")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, removed, kept = [], [], []
        for text, marks in zip(text_bytes(batch.column("text")), batch.column("marks")):
            marks = marks.values
            parts, at, gone = [], 0, 0
            if marks is not None and len(marks):
                a, b = (marks.field(i).to_numpy() for i in (0, 1))
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.append(True, a[1:] > b[:-1])
                a, b = a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]
            else:
                a = b = np.zeros(0, np.int64)
            for words in split_up(text):
                end = at + len(words)
                i, j = np.searchsorted(b, at, side="right"), np.searchsorted(a, end)
                left = 0
                for x, y in zip(a[i:j].tolist(), b[i:j].tolist()):
                    x, y = max(x, at) - at, min(y, end) - at
                    if x > left:
                        parts.append(b" ".join(words[left:x]))
                    gone += y - x
                    left = y
                if left < len(words):
                    parts.append(b" ".join(words[left:]))
                at = end
            totals.append(at)
            removed.append(gone)
            kept.append(b" ".join(parts))
        yield pa.RecordBatch.from_arrays([batch.column("kept_columns"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["kept_columns", "n_words", "n_removed", "kept"])


def remove_passages(docs: DataFrame, words: int = 13, crowd: int = 1000, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (doc_id by default) in a struct ``row``, n_words, n_removed and ``kept``: what is left of the
    text, its words joined by single spaces."""
    spark = small_batches(docs.sparkSession)
    marks = spans(docs, words, crowd).groupBy("doc_id", "row").agg(F.collect_list(F.struct("a", "b")).alias("marks"))
    marks = marks.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_hash"), "marks")
    own = docs.select(F.struct(*(keep or ["doc_id"])).alias("kept_columns"), "text", F.col("doc_id").cast("long").alias("_own"), F.xxhash64("text").alias("_text"))
    joined = own.join(marks, (F.col("_own") == F.col("_doc")) & (F.col("_text") == F.col("_hash")), "left").select("kept_columns", "text", "marks")
    kind = own.schema["kept_columns"].dataType.simpleString()
    return joined.mapInArrow(_cut, f"kept_columns {kind}, n_words long, n_removed long, kept string").withColumnRenamed("kept_columns", "row")


@query("op12_passages")
def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_passages(documents(spark, sf_dir))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
