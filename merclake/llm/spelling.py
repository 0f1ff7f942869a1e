"""Spelling variants: words of a corpus that differ by one letter, grouped under their commonest form.

Two words are near if one inserted, deleted or replaced letter turns one into the other. Their letter counts then have a
squared distance of two at most, and their lengths differ by one at most. So words are laid out in blocks of adjacent
lengths, a block's letter counts are multiplied with themselves (a Gram matrix), which gives all squared distances of
the block at once, and only the pairs within two are compared letter by letter.

A block of all words of a length would grow with the square of the vocabulary. One edit leaves either the front or the
back of a word as it is, so words meet in blocks of one front and blocks of one back. A block of more than ``crowd``
words is cut again: the edit lies in the first or in the second half of what the block has not fixed. That goes on
until a single place is left open, where a block has a word for each letter (two letters for the longer words), a
bound of the alphabet. A pair counts in the one block that holds its edit, so nothing is counted twice or lost.

Counting works on the distinct words of a batch of texts before the shuffle, blocks give sums per word instead of pairs.

Defined results: a null text has no words. Rows that repeat a doc_id count like any other; a null doc_id is the empty
string in the checksum. Of forms that occur equally often the smallest by code points is taken. Without words the
result is empty. Further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm.common import documents, grouped, small_batches, store
from merclake.llm.registry import query

#: Letters in Latin-1, where one letter is one byte; capitals A-Z are made small before.
LETTERS = re.compile(rb"[a-z\xc0-\xff]+")
#: One run in so many loses a letter.
CHANCE = 97
#: Columns of the letter counts: a-z have one each, the others share six. Merged columns only shrink distances.
COLUMNS = 32
#: Rows of blocks that are worked on together, cells of one Gram matrix, and letters laid out at once.
ROWS, CELLS, WIDE = 1 << 15, 1 << 22, 1 << 24

_COLUMN_OF = np.array([c - 97 if 97 <= c < 123 else 26 + c % 6 for c in range(256)], dtype=np.int64)
_KEY = ["length", "lo", "hi", "ends"]


def changed_word(prefix: int, word: bytes) -> bytes:
    """The word as it counts in a document: one in ``CHANCE`` loses a letter. ``prefix`` is the checksum of '<doc_id>:'."""
    h = crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
    if h % CHANCE:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counted(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches):
            total: Counter[bytes] = Counter()
            for doc_id, text in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()):
                if not text:
                    continue
                prefix = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # what Latin-1 lacks becomes a question mark, which ends a run as well
                for word, n in Counter(LETTERS.findall(text.encode("latin-1", "replace").lower())).items():
                    if len(word) >= shortest:
                        word = changed_word(prefix, word)
                        if len(word) >= shortest:
                            total[word] += n
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    return run


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, n: the words of at least ``shortest`` letters that occur ``least`` times or more."""
    small_batches(docs.sparkSession)
    parts = docs.select("doc_id", "text").mapInArrow(_counted(shortest), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _window(word: Column, length: Column, lo: Column, hi: Column) -> Column:
    """The letters that a block fixes: the first ``lo`` and those behind ``hi`` of the shorter length."""
    return F.concat(F.substr(word, F.lit(1), lo), F.when(hi < length, F.substr(word, F.char_length(word) - (length - hi) + 1)).otherwise(""))


def _halves(rows: DataFrame) -> DataFrame:
    """Cut the open letters [lo, hi) of every row into two halves."""
    middle = F.expr("cast((lo + hi) div 2 as int)")
    both = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    cut = rows.select("word", "n", "length", F.explode(both).alias("_w")).select("word", "n", "length", "_w.lo", "_w.hi")
    return cut.withColumn("ends", _window(F.col("word"), F.col("length"), F.col("lo"), F.col("hi")))


def blocks(words: DataFrame, shortest: int, crowd: int) -> DataFrame:
    """word, n, length, lo, hi, ends: each word once for every block it stands in; ``length`` is that of the shorter words."""
    size = F.char_length("word")
    lengths = F.when(size > shortest, F.array(size, size - 1)).otherwise(F.array(size))
    rows = words.select("word", "n", F.explode(lengths).alias("length")).withColumn("lo", F.lit(0)).withColumn("hi", F.col("length"))
    rows, settled = _halves(rows), []
    while True:
        crowds = store(rows.groupBy(_KEY).count().where((F.col("count") > crowd) & (F.col("hi") - F.col("lo") > 1)), "crowds").select(_KEY)
        if crowds.isEmpty():
            break
        settled.append(rows.join(crowds, _KEY, "left_anti"))
        rows = store(_halves(rows.join(crowds, _KEY, "left_semi")), "halves")
    for part in settled:
        rows = rows.unionByName(part)
    return rows


def _letter_counts(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, width = codes.shape
    live = np.arange(width) < sizes[:, None]
    cells = (np.arange(n)[:, None] * COLUMNS + _COLUMN_OF[codes])[live]
    return np.bincount(cells, minlength=n * COLUMNS).reshape(n, COLUMNS).astype(np.float32)


def near_rows(codes: np.ndarray, sizes: np.ndarray, begin: np.ndarray, count: np.ndarray, length: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near rows inside blocks. Block i has ``count[i]`` rows from ``begin[i]`` on."""
    vectors = _letter_counts(codes, sizes)
    lefts, rights, owners = [], [], []
    live = np.flatnonzero(count > 1)
    shape = 1 << np.ceil(np.log2(np.maximum(count, 2))).astype(np.int64)
    for m in np.unique(shape[live]):
        same = live[shape[live] == m]
        step = max(1, CELLS // int(m * m))
        upper = np.triu(np.ones((m, m), dtype=bool), 1)
        for at in range(0, len(same), step):
            part = same[at : at + step]
            inside = np.arange(m) < count[part, None]
            rows = np.where(inside, begin[part, None] + np.arange(m), 0)
            x = vectors[rows]
            gram = x @ x.transpose(0, 2, 1)
            square = np.einsum("bii->bi", gram)
            distance = square[:, :, None] + square[:, None, :] - 2 * gram
            total = sizes[rows][:, :, None] + sizes[rows][:, None, :]
            keep = (distance <= 2) & upper & inside[:, :, None] & inside[:, None, :] & (total <= 2 * length[part, None, None] + 1)
            block, i, j = np.nonzero(keep)
            lefts.append(rows[block, i])
            rights.append(rows[block, j])
            owners.append(part[block])
    if not lefts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, block = (np.concatenate(x) for x in (lefts, rights, owners))
    found = [_verified(a[s], b[s], block[s], codes, sizes, length, lo, hi) for s in (slice(i, i + ROWS) for i in range(0, max(1, len(a)), ROWS))]
    return tuple(np.concatenate(x) for x in zip(*found))


def _verified(a, b, block, codes, sizes, length, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """Of candidate pairs those that differ by one edit which lies in the open letters of their block."""
    swap = sizes[a] > sizes[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    x, y = codes[a], codes[b]
    width = codes.shape[1]
    differ = x != y
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    replaced = (sizes[a] == sizes[b]) & (differ.sum(axis=1) == 1)
    behind = (x[:, :-1] != y[:, 1:]) & (np.arange(width - 1) >= first[:, None])
    inserted = (sizes[b] == sizes[a] + 1) & ~behind.any(axis=1)
    at = np.minimum(first, length[block] - 1)
    good = (replaced | inserted) & (lo[block] <= at) & (at < hi[block])
    return a[good], b[good]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block in; for every word with near ones in a block their number and the commonest of them out."""

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole blocks; those of very long words, which come last, a few at a time."""
        sizes = [len(w) for w in table.column("word").to_pylist()]
        if len(sizes) * max(sizes) <= WIDE:
            yield from settle_some(table)
            return
        ends = list(zip(*(table.column(c).to_pylist() for c in _KEY)))
        begin, widest = 0, 0
        for i, size in enumerate(sizes):
            widest = max(widest, size)
            if i > begin and ends[i] != ends[i - 1] and (i - begin + 1) * widest > WIDE:
                yield from settle_some(table.slice(begin, i - begin).combine_chunks())
                begin, widest = i, size
        yield from settle_some(table.slice(begin).combine_chunks())

    def settle_some(table: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        n = table.column("n").to_numpy()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        width = int(sizes.max()) + 2
        codes = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in texts), np.uint8).reshape(-1, width)
        key = [table.column(c).to_numpy() for c in _KEY[:3]]
        ends = table.column("ends").to_pylist()
        new = np.ones(len(texts), dtype=bool)
        new[1:] = np.fromiter((x != y for x, y in zip(ends, ends[1:])), bool, len(texts) - 1)
        for k in key:
            new[1:] |= k[1:] != k[:-1]
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(texts)))
        a, b = near_rows(codes, sizes, begin, count, *(k[begin].astype(np.int64) for k in key))
        if not len(a):
            return
        own, other = np.concatenate((a, b)), np.concatenate((b, a))
        involved, rank = np.unique(np.array([texts[i] for i in other], dtype=object), return_inverse=True)
        order = np.lexsort((rank, -n[other], own))
        own, rank, other = own[order], rank[order], other[order]
        start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([texts[i].decode("latin-1") for i in own[start]], pa.string()), pa.array(np.diff(np.append(start, len(own)))),
                pa.array(n[other[start]]), pa.array([involved[i].decode("latin-1") for i in rank[start]], pa.string()),
            ],
            ["word", "n_near", "best_n", "best"],
        )

    held: pa.Table | None = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
        if held.num_rows < ROWS:
            continue
        last = [held.column(c)[-1].as_py() for c in _KEY]
        at = held.num_rows  # the last block may go on in the next batch
        while at and [held.column(c)[at - 1].as_py() for c in _KEY] == last:
            at -= 1
        if at:
            yield from settle(held.slice(0, at))
            held = held.slice(at).combine_chunks()
    if held is not None and held.num_rows:
        yield from settle(held)


def roots(forms: DataFrame) -> DataFrame:
    """word, root: follow ``form`` from word to word. Each form is at least twice as common as its word, so a chain is no
    longer than the binary logarithm of the largest count, and doubling the steps ends after its logarithm."""
    at = store(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not at.where("moved").isEmpty():
        step = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = at.join(step, "root", "left")
        at = store(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, times: int = 2, crowd: int = 1024) -> DataFrame:
    """word, n, n_near, form, form_n, root. ``form`` is the commonest near word if it occurs at least ``times`` (two or
    more) as often as the word; ``root`` the end of the chain of forms."""
    words = store(word_counts(docs, shortest, least), "words")
    laid = blocks(words, shortest, crowd).repartition(*_KEY).sortWithinPartitions(*_KEY)
    parts = laid.select("word", "n", *_KEY).mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    near = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    enough = -F.col("_best.less") >= times * F.col("n")
    found = store(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("_best.best")).alias("form"), F.when(enough, -F.col("_best.less")).alias("form_n"),
        ), "variants")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
