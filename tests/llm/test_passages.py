"""Repeated passages against brute force over all strings of words."""

import hashlib
import random
import re

import numpy as np
import pytest

from merclake.llm import passages as ps
from merclake.llm.common import documents

SF = "/root/testdata/sf0.001"


def brute(rows, words=13):
    """rows: (doc_id, text). Sorted (doc_id, n_words, n_removed, digest)."""
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    least = {}
    for (doc_id, _), w in zip(rows, split):
        if doc_id is not None:
            for i in range(len(w) - words + 1):
                key = tuple(w[i : i + words])
                least[key] = min(doc_id, least.get(key, doc_id))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = [False] * len(w)
        if doc_id is not None:
            for i in range(len(w) - words + 1):
                if least[tuple(w[i : i + words])] < doc_id:
                    gone[i : i + words] = [True] * words
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(doc_id), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r["row"]["doc_id"]), r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in df.collect())


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    want = brute(rows)
    assert sum(r[2] for r in want) > 500
    found = ps.op12_passages(spark, SF).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found) == want


@pytest.mark.parametrize("crowd", [0, 3, 40, 1000])
def test_few_words(spark, docs_of, crowd):
    """A tiny vocabulary: prefixes are crowded, strings overlap themselves. The bound of a group never shows."""
    rng = random.Random(crowd)
    rows = []
    for i in range(60):
        text = rng.choices("ab", k=rng.randint(0, 60))
        if i % 3 == 0:
            text += ["x", "y"] * rng.randint(3, 12)
        if rows and i % 4 == 0:
            other = rows[rng.randrange(len(rows))][1].split()
            text += other[rng.randint(0, 9) :]
        rows.append((i, " ".join(text)))
    assert got(ps.remove_passages(docs_of(rows), words=9, crowd=crowd)) == brute(rows, 9)


def test_passages_at_all_offsets(spark, docs_of):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=30)
    rows = []
    for i in range(80):  # parts of one passage in other surroundings, some too short
        a, b = sorted(rng.sample(range(31), 2))
        rows.append((100 - i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 30)) + passage[a:b] + rng.choices(vocabulary, k=rng.randint(0, 30)))))
    want = brute(rows)
    assert any(r[2] for r in want)
    for crowd in (0, 10, 2000):
        assert got(ps.remove_passages(docs_of(rows), crowd=crowd)) == want


def test_odd_rows(spark, docs_of, monkeypatch):
    line = " ".join(f"k{i}" for i in range(20))
    rows = [
        (1, None), (2, ""), (3, line), (3, line), (3, "other " + line + " text"), (None, line), (None, None), (4, line + "\x0b\x0c\r\n\t" + line), (5, " ".join(line.split())),
        (6, "one " * 30000), (7, "one " * 13), (8, "one " * 12), (-9, line[: len(line) // 2]), (10, line.replace(" ", "   ")),
    ]
    assert got(ps.remove_passages(docs_of(rows, clashing=True))) == brute(rows)
    assert ps.remove_passages(docs_of([])).count() == 0
    kept = ps.remove_passages(docs_of(rows, clashing=True), keep=["doc_id", "n", "kept"]).select("row.*", "n_words").columns
    assert kept == ["doc_id", "n", "kept", "n_words"]


def test_long_texts_come_in_parts():
    text = " ".join(f"w{i}" for i in range(5000)).encode()
    assert [w for part in ps.split_up(text, 1000) for w in part] == text.split()
    parts = list(ps.split_up(text, 1000))
    assert len(parts) > 20
    original = ps.split_up.__defaults__
    ps.split_up.__defaults__ = (1000,)
    try:
        seen = []
        for owner, first, lists in ps.blocks_of([text, b"a b", text], 13):
            for o, f, words in zip(owner, first, lists):
                runs = ps.Runs([words], 13, ps.Names())
                seen += [(o, f + s + i) for s, c in zip(runs.start.tolist(), runs.count.tolist()) for i in range(c)]
    finally:
        ps.split_up.__defaults__ = original
    assert seen == [(o, i) for o in (0, 2) for i in range(4988)]


def test_leftmost_least():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 4, 300).astype(np.uint64)
    for width in range(1, 20):
        found = ps.leftmost_least(values, width)
        for i in range(len(values) - width + 1):
            assert found[i] == i + int(np.argmin(values[i : i + width]))
