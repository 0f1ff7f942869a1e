"""Quality rules: gradient-boosted trees over document statistics.

One pass over the texts gives every document's statistics. The labelled ones among them train the trees, with
monotonic constraints: more symbols, repeated lines or repeated words never make a document better. The trees are
flattened into node arrays, which score the stored statistics batch by batch.

The trees are fitted on a bounded sample of the labelled rows (``sample``, those with the smallest hash of their id); every document is scored.

Defined results: a null or empty text has no words and fails the base rules. Labels of one id that disagree count
as bad; null labels don't count. Without labels of both classes the trees keep everything that the base rules keep.
Rows that repeat a doc_id are judged each. Without rows the result is empty. Further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merclake.llm import trees
from merclake.llm.common import documents, sampled, small_batches, store, text_bytes
from merclake.llm.registry import query

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_chars", "n_distinct")
#: Names of the features with the sign of their constraint on the odds of good quality.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0,
    "digit_share": 0, "mark_share": 0, "line_words": 0, "distinct_share": 0,
}
_SPACE = b"\t\n\x0b\x0c\r "
_SYMBOLS = b"#*$%&|<>"
_MARKS = b".,;:!?'\"()-"
#: From so many words on, windows are numbered instead of kept as tuples.
LONG = 50_000


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of words that is found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    if len(words) < LONG:
        windows = list(zip(*(words[i:] for i in range(window))))
        if len(set(windows)) == n:
            return 0
        times = Counter(windows)
        again = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=n)
    else:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
        code = ids[:n]
        for i in range(1, window):
            _, code = np.unique(code * len(number) + ids[i : n + i], return_inverse=True)
        again = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(window):
        covered[i : n + i] |= again
    return int(covered.sum())


def statistics(text: bytes) -> tuple[int, ...]:
    """The counts of a text, in the order of COUNTS."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    inked = text.translate(None, _SPACE)
    less = lambda marks: len(text) - len(text.translate(None, marks))
    return (
        len(words), len(inked.decode()), less(_SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines),
        less(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), less(b"0123456789"), less(_MARKS), len(text.decode()), len(set(words)),
    )


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Matrix of the features in the order of FEATURES."""
    c = {k: v.astype(np.float64) for k, v in counts.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1), np.maximum(c["n_lines"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_upper"] / chars, c["n_digits"] / chars, c["n_marks"] / chars, words / lines, c["n_distinct"] / words,
    ], axis=1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [statistics(x) for x in text_bytes(batch.column("text"))]
        cols = zip(*counts) if counts else repeat((), len(COUNTS))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols)], ["doc_id", *COUNTS])


def _score(forest: trees.Forest, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS}
            good = forest.probability(features(counts))
            failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
            names = ["doc_id", *COUNTS[:5], "base_failed", "score", "kept"]
            cols = [batch.column(c) for c in names[:6]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(failed), pa.array(good), pa.array(~failed & (good >= threshold))], names)

    return run


def train(counted: DataFrame, labels: DataFrame, sample: int = 20_000) -> trees.Forest:
    """Trees from the statistics of the labelled documents; ``labels`` has doc_id and quality."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_good"))
    rows = store(counted.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", *COUNTS, "_good"), "labelled")
    rows = sampled(rows, "doc_id", sample).collect()
    counts = {c: np.array([r[c] for r in rows], dtype=np.int64) for c in COUNTS}
    return trees.fit(features(counts), np.array([r["_good"] > 0 for r in rows], dtype=bool), tuple(FEATURES.values()))


def judge(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, base_failed, score (the odds of good quality as a probability) and kept."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(_count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    counted = store(counted, "statistics")
    forest = train(counted, labels, sample)
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS[:5]) + ", base_failed boolean, score double, kept boolean"
    return counted.mapInArrow(_score(forest, threshold), schema)


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
