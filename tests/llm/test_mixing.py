"""The mix against SQL and a plain reckoning, its schedule inversion against numerical integration."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from agreement import connect, disagreement
from merclake.llm import mixing

SF = "/root/testdata/sf0.001"


def plain(rows, weights=(5, 2, 1)):
    """(doc_id, size, target, taken) by definition; rows (doc_id, text, lang, source)."""
    size = [len((r[1] or "").split()) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * total[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        free -= full
    out = {}
    for s in names:
        at, wanted = 0, int(target[s] + 0.5)
        own = [i for i, r in enumerate(rows) if r[3] == s]
        for i in sorted(own, key=lambda i: (hashlib.md5(f"mix-{rows[i][0]}".encode()).hexdigest(), size[i])):
            whole = wanted // total[s] if total[s] else 0
            out[i] = whole * size[i] + min(max(wanted - whole * total[s] - at, 0), size[i])
            at += size[i]
    return [(r[0], size[i], target[r[3]], out[i]) for i, r in enumerate(rows)]


def test_query_agrees_with_sql(spark):
    assert disagreement(connect(SF), mixing.op7_mixing(spark, SF), mixing.SQL) is None


def test_hot_sources_nulls_and_repeats(spark, docs_of):
    rows = [(i, "w " * (i % 7), None, f"s{0 if i % 3 else i % 5}") for i in range(400)]
    rows += [(i, "a b c", "en", None) for i in range(400, 420)] + [(1000, None, None, None), (1001, "", None, ""), (1001, "x\x0by\x0cz", None, ""), (7, "w " * 9, None, "s0"), (7, "w " * 9, None, "s0")]
    rows += [(2000, "long " * 60000, None, "zz"), (2001, None, None, "empty")]
    mixed = mixing.mix(docs_of(rows, clashing=True))
    got = sorted((r["doc_id"], r["size"], round(r["target"], 6), r["taken"]) for r in mixed.collect())
    assert got == sorted((d, n, round(t, 6), k) for d, n, t, k in plain(rows))
    assert mixed.where("taken > 2 * size").count() == 0
    by = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.5 for r in by)
    order = mixing.training_order(mixed).collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    assert sum(r["words"] for r in order) == sum(r["taken"] for r in mixed.collect())
    assert all(0 <= r["position"] <= 1 for r in order)


def test_empty(spark, docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    assert [r["taken"] for r in mixing.mix(docs_of([(1, None, None, "a"), (2, "", None, None)])).collect()] == [0, 0]


@pytest.mark.parametrize("knots", mixing.SCHEDULES)
def test_inverted_demand(spark, knots):
    shares = [0.0, 0.01, 0.3, 0.5, 0.77, 0.999, 1.0]
    frame = spark.createDataFrame([(s,) for s in shares], "s double")
    times = [r[0] for r in frame.select(mixing.invert_demand(F.col("s"), knots)).collect()]
    grid = np.linspace(0, 1, 200001)
    strength = np.interp(grid, [k for k, _ in knots], [v for _, v in knots])
    demand = np.concatenate(([0], np.cumsum((strength[1:] + strength[:-1]) / 2))) / ((strength[1:] + strength[:-1]) / 2).sum()
    assert np.allclose(np.interp(times, grid, demand), shares, atol=1e-6)
