"""Spelling variants against brute force over all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

from merclake.llm import spelling as sp
from merclake.llm.common import documents

SF = "/root/testdata/sf0.001"
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, shortest=5, least=3, pairs=None):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(CAPITALS)
            h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= shortest:
                n[word] += 1
    words = sorted(w for w in n if n[w] >= least)
    near = {w: [] for w in words}
    by_cut = {}
    for w in words:  # words that share a string with one letter cut out, or are such a string
        for cut in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_cut.setdefault(cut, []).append(w)
    for group in by_cut.values():
        for a in group:
            near[a] += [b for b in group if b != a and one_edit(a, b)]
    out, form = {}, {}
    for w in words:
        around = set(near[w])
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (n[w], len(around))
    result = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        result.add((w, *out[w], form[w], n[form[w]] if form[w] is not None else None, root))
    return result


def got(df):
    rows = [tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    want = brute(rows)
    assert any(r[3] for r in want) and any(r[5] != (r[3] or r[0]) for r in want)
    assert got(sp.op11_spelling_variants(spark, SF)) == want


def test_crowded_blocks(spark, docs_of):
    """Few letters, so that blocks are cut again and again; the bound must not change the result."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(700)]
    rows = [(i, " ".join(rng.choices(words, k=400))) for i in range(20)]
    want = brute(rows)
    for crowd in (1, 7, 10_000):
        assert got(sp.spelling_variants(docs_of(rows), crowd=crowd)) == want


def test_long_words(spark, docs_of):
    """Words of a million letters, laid out a few at a time."""
    a = "y" * 1_000_000
    rows = [(1, f"{a} {a} {a} {a}z {a}z {a}z {a}z {a}z {a}z " + "short short short shore " * 9)]
    found = {r[0][-6:] + str(len(r[0])): (r[1], r[2], r[3] and len(r[3]), len(r[5])) for r in got(sp.spelling_variants(docs_of(rows)))}
    assert found == {"yyyyyy1000000": (3, 1, 1000001, 1000001), "yyyyyz1000001": (6, 1, None, 1000001), "short5": (27, 1, None, 5), "shore5": (9, 1, 5, 5)}


def test_odd_rows(spark, docs_of):
    rows = [
        (1, None), (2, ""), (3, "Colour colour COLOUR color color color color color color color"), (3, "colour"), (None, "colors colors Colors colorz"),
        (4, "ÀÀÀÀÀÀ ÀÀÀÀÀÀ ÀÀÀÀÀÀ àÀÀÀÀÀ àÀÀÀÀÀ àÀÀÀÀÀ naïve×naïve naïve÷ naïves naïves naïves 漢字colour"), (5, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa " * 3000),
        (6, "zebra zebra zebra zebrb zebrb zebrb zebrc zebrc zebrc"), (7, "x" * 20000), (8, ("y" * 300 + " ") * 3 + ("y" * 301 + " ") * 9),
    ]
    assert got(sp.spelling_variants(docs_of(rows, clashing=True))) == brute(rows)
    assert sp.spelling_variants(docs_of([])).count() == 0
    assert sp.spelling_variants(docs_of([(1, None), (2, "a b")])).count() == 0
