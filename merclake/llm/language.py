"""Language ID by rank-order n-gram profiles.

Each language's profile is the list of its most frequent n-grams (one to three letters, words padded with a
boundary mark). A document is compared with a profile by the out-of-place distance: the sum, over the document's
own most frequent n-grams, of the difference of the two ranks; an n-gram the profile lacks costs the whole length.

Defined results: a null text, or one without letters, is ``und`` with score 0. Without any training row every
document is ``und``. Equal counts rank by n-gram length and code points, equal distances by language name.
Repeated rows count as often as they stand. Further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merclake.llm.common import documents, grouped, chunk, remainder, small_batches
from merclake.llm.registry import query

UNDETERMINED = "und"
#: Stands for anything that is no letter; consecutive ones are one.
BOUNDARY = 1
#: Texts are handled in pieces of so many characters.
PIECE = 1 << 19
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of other characters as one boundary, one at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    points[~_letters()[points]] = BOUNDARY
    points = np.concatenate(([BOUNDARY], points, [BOUNDARY]))
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != BOUNDARY) | (points[:-1] != BOUNDARY)
    return points[keep]


class Grams:
    """N-grams of a sequence of symbols, numbered densely from 0 in the order of length and code points."""

    def __init__(self, points: np.ndarray):
        seen = np.zeros(0x110000, dtype=bool)
        seen[points] = True
        seen[BOUNDARY] = True
        self.alphabet = np.flatnonzero(seen)
        place = np.zeros(0x110000, dtype=np.int64)
        place[self.alphabet] = np.arange(len(self.alphabet))
        self.ids = place[points]
        self.edge = int(place[BOUNDARY])
        self.width = len(self.alphabet)

    def dense(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Codes of all n-grams that occur, ascending; and for n = 1, 2, 3 the number of the n-gram that starts at
        each position, or -1 where it is none."""
        k, ids, a = self.width, self.ids, self.alphabet
        codes, numbers, at = [], [], 0
        for n in (1, 2, 3):
            m = max(0, len(ids) - n + 1)
            own, packed = np.zeros(m, dtype=np.int64), np.zeros(m, dtype=np.int64)
            wide = k**n > 1 << 22
            for i in range(n):
                own = own * k + ids[i : i + m]
                if wide:
                    packed = (packed << 21) | a[ids[i : i + m]]
            inner = ids[n // 2 : n // 2 + m] if n != 2 else None
            valid = inner != self.edge if inner is not None else (ids[:m] != self.edge) | (ids[1 : 1 + m] != self.edge)
            if wide:  # large alphabets: sort instead of a table
                found, inverse = np.unique(packed[valid], return_inverse=True)
                number = np.full(m, -1, dtype=np.int64)
                number[valid] = inverse + at
            else:
                flags = np.zeros(k**n, dtype=bool)
                flags[own[valid]] = True
                present = np.flatnonzero(flags)
                table = np.full(k**n, -1, dtype=np.int64)
                table[present] = np.arange(len(present)) + at
                number = table[own]
                number[~valid] = -1
                found = np.zeros(len(present), dtype=np.int64)
                rest = present.copy()
                for i in range(n):
                    found |= a[rest % k] << (21 * i)
                    rest //= k
            codes.append(found)
            numbers.append(number)
            at += len(found)
        return np.concatenate(codes), numbers


def _pieces(texts: list[str]) -> Iterator[list[str]]:
    """Lists of texts of about PIECE characters together."""
    held, size = [], 0
    for x in texts:
        held.append(x)
        size += len(x)
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language, the n-grams of a task's documents with their counts."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def out(lang: str) -> pa.RecordBatch:
        codes, counts = sums.pop(lang)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

    for table in grouped(batches):
        by: dict[str, list[str]] = {}
        for lang, text in zip(table.column("lang").to_pylist(), table.column("text").to_pylist()):
            by.setdefault(lang, []).append(text or "")
        for lang, texts in by.items():
            for piece in _pieces(texts):
                codes, numbers = Grams(symbols("\0".join(piece))).dense()
                if not len(codes):
                    continue
                every = np.concatenate(numbers)
                counts = np.bincount(every[every >= 0], minlength=len(codes))
                if lang in sums:
                    both = np.concatenate((sums[lang][0], codes))
                    codes, inverse = np.unique(both, return_inverse=True)
                    counts = np.bincount(inverse, weights=np.concatenate((sums[lang][1], counts))).astype(np.int64)
                sums[lang] = (codes, counts)
                if len(codes) > 1 << 20:  # many scripts: hand on what there is
                    yield out(lang)
    for lang in list(sums):
        yield out(lang)


def profiles(docs: DataFrame, learn: Column, size: int = 400) -> dict[str, list[int]]:
    """Each language's ``size`` most frequent n-grams over all rows that ``learn`` selects. Counts are summed in
    the tasks first; what reaches the driver is ``size`` numbers for a language."""
    small_batches(docs.sparkSession)
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sums = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("gram")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(*order)
    best = sums.withColumn("r", F.row_number().over(part)).where(F.col("r") <= size)
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= size)
    found: dict[str, list[tuple[int, int]]] = {}
    for row in best.select("lang", "gram", "r").collect():
        found.setdefault(row["lang"], []).append((row["r"], row["gram"]))
    return {lang: [gram for _, gram in sorted(found[lang])] for lang in sorted(found)}


def _nearest(codes, counts, langs, known, ranks, size) -> tuple[str, float]:
    if len(counts) > size:  # all above the count at the cut, then the first of those that equal it
        cut = np.partition(counts, len(counts) - size)[len(counts) - size]
        above, equal = np.flatnonzero(counts > cut), np.flatnonzero(counts == cut)
        own = np.sort(np.concatenate((above, equal[: size - len(above)])))
    else:
        own = np.arange(len(counts))
    own = own[np.argsort(-counts[own], kind="stable")]
    grams = codes[own]
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    hit = known[at] == grams
    theirs = np.where(hit[None, :], ranks[:, at], size)
    distance = np.where(theirs == size, size, np.abs(theirs - np.arange(len(grams))[None, :])).sum(axis=1)
    best = int(np.argmin(distance))
    return langs[best], float(1.0 - distance[best] / (size * len(grams)))


def predictor(found: dict[str, list[int]], size: int):
    """mapInArrow function: doc_id, held_out, text in; doc_id, held_out, lang_pred, score out."""
    langs = list(found)
    known = np.array(sorted({g for grams in found.values() for g in grams}), dtype=np.int64)
    ranks = np.full((len(langs), len(known)), size, dtype=np.int64)
    for i, lang in enumerate(langs):
        ranks[i, np.searchsorted(known, np.array(found[lang], dtype=np.int64))] = np.arange(len(found[lang]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            judged = []
            for piece in _pieces([x or "" for x in texts]):
                judged += judge(piece, langs, known, ranks, size)
            out = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            out += [pa.array([x[0] for x in judged], pa.string()), pa.array([x[1] for x in judged], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, [*names, "lang_pred", "score"])

    return predict


def judge(texts: list[str], langs, known, ranks, size) -> list[tuple[str, float]]:
    """Language and score of each text. ``known`` are the n-grams of all profiles, ascending, ``ranks`` their
    rank in each language, or ``size`` where it lacks them. The texts share one numbering of their n-grams."""
    if not langs:
        return [(UNDETERMINED, 0.0)] * len(texts)
    parts = [symbols(x) for x in texts]
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    codes, numbers = Grams(np.concatenate(parts)).dense()
    if not len(codes):
        return [(UNDETERMINED, 0.0)] * len(texts)
    out = []
    for i in range(len(texts)):
        a, b = int(starts[i]), int(starts[i + 1])
        # an n-gram that starts at the last boundary would reach into the next text
        own = np.concatenate([number[a : b - n] for n, number in enumerate(numbers)])
        own = own[own >= 0]
        if not len(own):
            out.append((UNDETERMINED, 0.0))
            continue
        if len(own) * 8 < len(codes):
            there, counts = np.unique(own, return_counts=True)
        else:
            counts = np.bincount(own, minlength=len(codes))
            there = np.flatnonzero(counts)
            counts = counts[there]
        out.append(_nearest(codes[there], counts, langs, known, ranks, size))
    return out


def identify(docs: DataFrame, held_out: Column, size: int = 400, keep: list[str] | None = None) -> DataFrame:
    """Predict each document's language with profiles of ``size`` n-grams, learnt from the rows with a known
    ``lang`` that are not held out. Returns doc_id, or a struct ``row`` of the columns ``keep``; held_out, lang_pred, score."""
    found = profiles(docs, ~held_out, size)
    rows = docs.select(F.struct(*(keep or ["doc_id"])).alias("row"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    judged = rows.mapInArrow(predictor(found, size), f"row {kind}, held_out boolean, lang_pred string, score double")
    return judged.select("row" if keep else "row.doc_id", "held_out", "lang_pred", "score")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, remainder("doc_id", 4) == 2)
