"""Repeated byte strings against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from merclake.llm import suffix_dedup as sd
from merclake.llm.common import documents
from merclake.llm.suffixes import group_of, pack, unpack

SF = "/root/testdata/sf0.001"


def slow(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha, kept text)."""
    least = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        if d is not None:
            for i in range(len(t) - length + 1):
                w = t[i : i + length]
                least[w] = min(d, least.get(w, d))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        if d is not None:
            for i in range(len(t) - length + 1):
                if least[t[i : i + length]] < d:
                    gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(t) else 0))
        text, at = "", 0
        for c in t.decode():
            n = len(c.encode())
            text += "" if gone[at : at + n].any() else c
            at += n
        out.append((str(d), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), text))
    return sorted(out)


def got(df):
    rows = df.collect()
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"], r["kept"]) for r in rows)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in sd.op8_suffix_dedup(spark, SF).collect())
    assert found == [r[:5] for r in slow(rows)]


def test_odd_rows(spark, docs_of):
    a = "The quick brown fox jumps over the lazy dog and runs away from it all."
    rows = [(5, None), (4, ""), (3, a), (9, a), (9, a), (7, a[:49]), (8, "x" + a[3:53] + "y"), (1, "z" * 300), (2, "z" * 120 + a), (None, a), (None, a), (6, "ü" * 40 + "é"), (10, "a" + "ü" * 30 + "ñ"), (11, a[:30]), (12, a + "\0" + a)]
    rows += [(20, a[5:60]), (20, "other " + a[9:64] + a[:52]), (20, "nothing in common with any of the above, not at all, no")]  # one id, three texts
    rows += [(30, "w" + "ab" * 40000), (31, "ab" * 300)]
    assert got(sd.remove_repeats(docs_of(rows, clashing=True))) == slow(rows)
    assert got(sd.remove_repeats(docs_of([]))) == []


@pytest.mark.parametrize("small", [False, True])
def test_random_edits_and_crowds(spark, docs_of, monkeypatch, small):
    """Copies with edits and a passage that many texts share; also with limits so small that all paths run."""
    if small:
        for name, value in (("PIECE", 700), ("PACKED", 40), ("CROWD_HERE", 2), ("CROWD", 3)):
            monkeypatch.setattr(sd, name, value)
    rng = random.Random(8)
    words = ["the", "of", "and", "ar", "tion", "ing", "ment", "ou", "les", "ü"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    passage, base = prose(12), [prose(60) for _ in range(6)]
    rows = []
    for i in range(150):
        parts = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 5)):
            parts[rng.randrange(len(parts))] = rng.choice(words)
        at = rng.randrange(len(parts))
        rows.append((rng.randrange(10**12) - 5 * 10**11, " ".join(parts[:at] + ([passage] if i % 2 else []) + parts[at:])))
    assert got(sd.remove_repeats(docs_of(rows))) == slow(rows)


def test_other_lengths(spark, docs_of):
    rows = [(i, " ".join(random.Random(i % 7).choices(["aa", "bb", "cc", "dd"], k=40)) + str(i % 3) * i) for i in range(40)]
    for length, name in ((20, 8), (33, 32), (64, 16)):
        assert [r[:5] for r in got(sd.remove_repeats(docs_of(rows), length, name))] == [r[:5] for r in slow(rows, length)]


def test_group_of_is_sparks_hash(spark):
    ids = [0, 1, -1, 7, 2**62, -(2**63), 123456789]
    frame = spark.createDataFrame([(i,) for i in ids], "i long").select(F.pmod(F.xxhash64("i"), F.lit(816)))
    assert [r[0] for r in frame.collect()] == group_of(np.array(ids), 816).tolist()


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        cols = [rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(-(2**40), 2**40, n), rng.integers(0, 255, n, dtype=np.uint8)]
        assert all((a == b).all() for a, b in zip(cols, unpack(pack(*cols), ("<u8", "<i8", "u1"))))
