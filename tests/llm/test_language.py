"""Language ID: a slow reckoning of profiles and distances, held-out accuracy, odd rows."""

import zlib
from collections import Counter

from pyspark.sql import functions as F

from merclake.llm import language
from merclake.llm.common import documents, remainder

SF = "/root/testdata/sf0.01"


def grams(text):
    cleaned = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    counts = Counter()
    for word in cleaned.split():
        padded = f"\1{word}\1"
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def ranked(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), [ord(c) for c in x[0]]))[:size]]


def slow(rows, size):
    sums = {}
    for doc_id, text, lang in rows:
        if lang is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2 and text is not None:
            sums.setdefault(lang, Counter()).update(grams(text))
    profile = {lang: {g: i for i, g in enumerate(ranked(sums[lang], size))} for lang in sorted(sums) if sums[lang]}
    out = []
    for doc_id, text, _ in rows:
        own = ranked(grams(text), size)
        if not own or not profile:
            out.append((doc_id, "und", 0.0))
            continue
        cost = {p: sum(abs(profile[p][g] - i) if g in profile[p] else size for i, g in enumerate(own)) for p in profile}
        best = min(cost, key=lambda p: (cost[p], p))
        out.append((doc_id, best, 1 - cost[best] / (size * len(own))))
    return out


def compare(df, rows, size):
    got = sorted((r["doc_id"] or -1, r["lang_pred"], round(r["score"], 9)) for r in df.collect())
    assert got == sorted((d or -1, p, round(s, 9)) for d, p, s in slow(rows, size))


def test_equals_slow_version(spark):
    docs = documents(spark, "/root/testdata/sf0.001").limit(60)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    compare(language.identify(frame, remainder("doc_id", 4) == 2, size=150), rows, 150)


def test_odd_rows(spark, docs_of):
    rows = [(1, None, "en"), (2, "", "de"), (3, "12 !?", "en"), (4, "The cat", "en"), (5, "Der Hund", "de"), (6, "the cat", None), (6, "the cat", None), (7, "Ünß 漢字 word", "de"), (8, "cat\0dog", "en"), (None, "the dog", "fr"), (9, "x", None), (10, "the der " * 30000, None)]
    compare(language.identify(docs_of(rows, clashing=True), remainder("doc_id", 4) == 2, size=20), rows, 20)
    assert language.identify(docs_of([]), remainder("doc_id", 4) == 2).count() == 0
    alone = language.identify(docs_of([(1, "word", None)]), remainder("doc_id", 4) == 2).first()
    assert (alone["lang_pred"], alone["score"]) == ("und", 0.0)


def test_large_alphabets(monkeypatch):
    """The sorted numbering of n-grams equals the tabled one."""
    points = language.symbols("漢字かな交じり文 and the rest, ünd dies")
    small = language.Grams(points).dense()
    g = language.Grams(points)
    g.width, old = 1 << 12, g.width  # forces sorting
    wide = g.dense()
    assert old < g.width and (small[0] == wide[0]).all()
    assert all((a == b).all() for a, b in zip(small[1][1:], wide[1][1:]))


def test_held_out_accuracy(spark):
    judged = language.op5_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out")
    right, n = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.99
