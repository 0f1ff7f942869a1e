"""Document statistics against slow definitions; the trees' constraints and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from merclake.llm import quality, trees
from merclake.llm.common import documents, remainder

SF = "/root/testdata/sf0.01"


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS = [None, "", " \t\n", "a", "a a a a", "x y z x y z", "a b c d a b c", "one\ntwo\none\n \n \none ", "ü é 漢 ü é 漢\x0bü é 漢", "#*$%&|<> a#b", "w " * 60, " ".join(f"w{i}" for i in range(60)), "a\x00b c\x1cd e\u00a0f"]


def test_statistics():
    rng = random.Random(1)
    for text in TEXTS + ["".join(rng.choices("ab \n#", k=rng.randint(0, 80))) for _ in range(200)]:
        assert quality.statistics((text or "").encode())[:5] == slow(text), text


def test_long_texts_count_alike(monkeypatch):
    rng = random.Random(2)
    for n in (0, 2, 3, 4, 50, 200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
        monkeypatch.setattr(quality, "LONG", 10**9)
        short = quality.repeated_words(words)
        monkeypatch.setattr(quality, "LONG", 0)
        assert quality.repeated_words(words) == short


def test_whole_table(spark):
    rows = {r["doc_id"]: r["text"] for r in documents(spark, "/root/testdata/sf0.001").collect()}
    got = quality.op4_quality_rules(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(rows)
    for r in got:
        want = slow(rows[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS[:5]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"]) and 0 <= r["score"] <= 1


def test_odd_rows(spark, docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, "a"), (99, "very long " * 40000)]
    labels = spark.createDataFrame([(11, 1), (11, 0), (10, 1), (None, 1), (5, None), (99, 0), (3, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        got = quality.judge(docs_of(rows, clashing=True), known).collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_repeat_words"]) for r in got) == sorted((str(d), slow(t)[0] if d != 99 else 80000, slow(t)[4] if d != 99 else 80000) for d, t in rows)
    assert quality.judge(docs_of([]), labels).count() == 0


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = remainder("doc_id", 3) == 0
    judged = quality.judge(documents(spark, SF), labels.where(~held)).join(labels.where(held), "doc_id")
    good, bad = (judged.where(F.col("quality") == q).agg(F.avg((F.col("score") >= 0.5).cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.98 and bad < 0.1


def walk(forest, row):
    out = forest.base
    for node in forest.roots:
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        out += forest.value[node]
    return out


@pytest.mark.parametrize("sign", [1, -1, 0])
def test_trees(sign):
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 3))
    labels = (rows[:, 0] + 0.5 * rows[:, 1] ** 2 + rng.normal(scale=0.3, size=3000)) > 0.3
    forest = trees.fit(rows, labels, (sign, 0, 0))
    raw = forest.raw(rows)
    assert np.allclose(raw[:50], [walk(forest, r) for r in rows[:50]])
    if sign >= 0:
        assert ((raw > 0) == labels).mean() > 0.9
    if sign:
        for r in rows[:20]:
            line = np.tile(r, (200, 1))
            line[:, 0] = np.linspace(-4, 4, 200)
            assert (np.diff(forest.raw(line)) * sign >= -1e-12).all()


def test_trees_without_both_classes():
    for labels in ([], [1, 1, 1], [0, 0]):
        forest = trees.fit(np.zeros((len(labels), 2)), np.array(labels))
        p = forest.probability(np.zeros((4, 2)))
        assert len(forest.roots) == 0 and ((p >= 0.5) == (sum(labels) * 2 >= len(labels))).all()
