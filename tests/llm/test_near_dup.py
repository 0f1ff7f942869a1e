"""Near-duplicates against a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash

from merclake.llm import near_dup
from merclake.llm.common import documents
from merclake.llm.components import components


def slow_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def slow_components(prints, ids, distance=3):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for p, d in zip(prints, ids):
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [least.get(find(p)) for p in prints]


def same(df, rows):
    prints = [slow_print(r[1]) for r in rows]
    want = sorted((r[0] is None, r[0] or 0, p, str(c)) for r, p, c in zip(rows, prints, slow_components(prints, [r[0] for r in rows])))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] % 2**64, str(r["component_id"])) for r in df.collect())
    assert got == want


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, sf).collect()]
    got = near_dup.op10_near_duplicates(spark, sf).collect()
    prints = [slow_print(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], [f"{p:016x}" for p in prints], slow_components(prints, [r[0] for r in rows])))
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_edge_rows(spark, docs_of):
    words = " ".join(f"w{i}" for i in range(400))
    rows = [(5, None), (3, ""), (9, " \t\n"), (2, "One"), (7, "one"), (7, "one"), (8, "a b"), (1, words), (4, words.upper()), (6, words + " x" * 70000), (None, "one"), (None, "alone here now")]
    same(near_dup.near_duplicates(docs_of(rows, clashing=True)), rows)
    same(near_dup.near_duplicates(docs_of([])), [])


def test_rows_without_id_link(spark, docs_of):
    """Near copies of a few texts, half of them without an id: chains go through those too."""
    rng = random.Random(12)
    rows, prints = [], []
    for base in range(3):
        words = [f"w{base}x{rng.randrange(10**6)}" for _ in range(600)]
        for _ in range(60):
            words = list(words)
            words[rng.randrange(600)] = f"v{rng.randrange(10**6)}"
            prints.append(slow_print(" ".join(words)))
            rows.append((len(rows) if rng.random() < 0.5 else None, " ".join(words)))
    rows.append((None, "no id and no neighbour"))
    chained = [i for i, p in enumerate(prints) if any(0 < (p ^ q).bit_count() <= 3 and rows[j][0] is None for j, q in enumerate(prints))]
    assert len(chained) > 30
    same(near_dup.near_duplicates(docs_of(rows)), rows)


def test_links_at_every_distance(spark):
    """Planted distances 0 to 8, and a crowd under one key; connectivity must equal that of all pairs."""
    rng = random.Random(5)
    prints = {0}
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(4):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 8)))
            prints.add(p)
    base = rng.getrandbits(64)
    crowd = {base ^ (rng.getrandbits(10) << 40) ^ (1 << rng.randrange(64)) for _ in range(150)}
    prints = sorted(prints | crowd)
    ids = list(range(100, 100 + len(prints)))
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    nodes = spark.createDataFrame(list(zip(signed, ids)), "fp long, rep long")
    for distance in (0, 1, 3, 5):
        want = slow_components(prints, ids, distance)
        for size in (near_dup.CROWD, 8):
            edges = near_dup.links(nodes, distance, crowd=size)
            found = {r["node"]: r["root"] for r in components(edges).collect()}
            assert [found.get(i, i) for i in ids] == want


def test_distance_bounds(spark):
    with pytest.raises(ValueError):
        near_dup.links(spark.createDataFrame([], "fp long, rep long"), 8)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (None, 3), (60, 70), (70, 60), (90, 60)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 60: 60, 70: 60, 90: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
