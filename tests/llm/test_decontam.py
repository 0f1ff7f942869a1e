"""Benchmark overlaps against a comparison at every offset."""

import itertools
import random

import numpy as np
import pytest

from merclake.llm import decontam
from merclake.llm.common import documents

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def slow(docs, items, least=12, shortest=5):
    """(doc_id, item_id, n_tokens, n_agree) of the best run, by trying every run at every offset."""
    out = {}
    for (d, text), (i, item) in itertools.product(docs, items):
        a, b = [w for w in words(text) if w], [w for w in words(item) if w]
        if len(b) < shortest:
            continue
        need = min(least, len(b))
        percent = 80 if len(b) >= least else 100
        for off in range(need - len(b), len(a) - need + 1):
            lo, hi = max(0, -off), min(len(b), len(a) - off)
            agree = [a[off + x] == b[x] for x in range(lo, hi)]
            if sum(agree) * 100 < percent * need * 0.8:
                continue
            for s in range(len(agree)):
                for e in range(s + need, len(agree) + 1):
                    n = sum(agree[s:e])
                    if n * 100 >= percent * (e - s):
                        key = (n * 100 - 80 * (e - s), -(off + lo + s), -(lo + s), e - s, n)
                        out[d, i] = max(out.get((d, i), key), key)
    return sorted((str(d), str(i), k[0], -k[1]) for (d, i), k in out.items())


def got(df):
    return sorted((str(r["doc_id"]), str(r["item_id"]), r["n_agree"] * 100 - 80 * r["n_tokens"], r["doc_start"]) for r in df.collect())


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    items = [(r["item_id"], r["text"]) for r in documents(spark, SF, "benchmark").collect()]
    found = got(decontam.op9_decontamination(spark, SF))
    assert found == slow(docs, items) and len({f[0] for f in found}) > 2


def test_substitutions_and_odd_rows(spark, docs_of):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate((60, 30, 15, 12, 11, 8, 6, 5, 4, 1))] + [(None, "Null item ÜBER all the things that one two three four five"), (90, None), (91, ""), (1, "w1 w2 w3 w4 w5 w6 w7")]
    docs = [(100, None), (101, ""), (102, "w1 " * 60000), (None, "x " + items[1][1]), (103, items[10][1].lower()), (104, items[10][1].replace("Ü", "ü"))]
    for n in range(40):
        out = rng.choices(vocab, k=rng.randint(0, 40))
        for i, text in rng.sample(items[:10], 2):
            part = text.split()
            for _ in range(rng.randint(0, 1 + len(part) // 4)):
                part[rng.randrange(len(part))] = "other"
            at = rng.randint(0, len(out))
            out[at:at] = part[rng.randint(0, 5) if len(part) > 25 else 0 :]
        docs.append((n, ", ".join(out)))
    docs += docs[-3:]
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontam.overlaps(docs_of(docs, clashing=True), tests)) == slow(docs, items)
    kept = decontam.clean(docs_of(docs), tests)
    bad = {r[0] for r in slow(docs, items)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if str(d) not in bad)
    assert decontam.overlaps(docs_of([]), tests).count() == 0
    assert decontam.overlaps(docs_of(docs), tests.limit(0)).count() == 0


@pytest.mark.parametrize("n", [12, 13, 15, 16, 20])
def test_masks_hit_every_tolerated_pattern(n):
    wrong = n - -(-8 * n // 10)
    for gaps in itertools.combinations(range(n), wrong):
        agree = np.ones(n, dtype=bool)
        agree[list(gaps)] = False
        assert any(agree[[at + o for o in decontam.offsets(m)]].all() for m in decontam.MASKS for at in range(n - len(m) + 1))
