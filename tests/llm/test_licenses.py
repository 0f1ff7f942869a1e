"""Plain phrases against a slow search; templates planted whole, altered and without their key phrase."""

import re

import pytest

from merclake.llm import licenses
from merclake.llm.common import documents

SF = "/root/testdata/sf0.01"


def slow(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(rows, got):
    base = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted((str(r["doc_id"]), *(str(r[c]) for c in base)) for r in got) == sorted((str(d), *map(str, slow(t))) for d, t in rows)
    for r in got:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    got = licenses.op1_license_scans(spark, SF).collect()
    check(rows, got)
    texts = dict(rows)
    for r in got:
        for line, label in (("CC BY-NC 4.0", "cc-by-nc"), ("Apache License, Version 2.0", "apache-2.0"), ("Released under the MIT License", "mit")):
            assert (line in texts[r["doc_id"]]) <= (label in r["labels"].split(","))
        assert bool(r["labels"]) == (r["score"] > 0)


def test_odd_rows(spark, docs_of):
    texts = [None, "", "MIT", "mit  LICENSE", "MIT-License mit_license mit\nlicense mitlicense", "cc by cc by cc", "Apache-License", "GNU General\x00Public\tLicense", "gnu gnu general public license", "ümit license", "the " * 70000 + "MIT license", "cc by"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "cc by"), (3, "mit  LICENSE")]
    check(rows, licenses.scan(docs_of(rows, clashing=True)).collect())
    assert licenses.scan(docs_of([])).count() == 0


@pytest.mark.parametrize("t", range(len(licenses.TEMPLATES)))
def test_each_template(t):
    label, keys, text = licenses.TEMPLATES[t]
    index = licenses.Index()
    index.weigh(1000, {w: 900 for w in (b"the", b"of", b"and", b"is", b"under", b"a", b"to", b"in")})
    filler = [b"the", b"other", b"word", b"of", b"license", b"software"] * 20
    words = [w.encode() for w in text.split()]
    assert index.scan(filler + words + filler)[1][label] == 1.0
    assert index.scan(filler)[1] == {}
    if len(words) > 12:  # an inserted year moves the rest
        assert index.scan(filler + words[:3] + [b"2024"] + words[3:] + filler)[1].get(label, 0) > 0.7 or words[:4] == [w.encode() for w in keys[0].split()][:4]
    broken = [w for w in words if w not in {k.split()[0].encode() for k in keys}]
    only = index.scan(broken)[1]
    assert label not in only or any(x == label and i != t for i, (x, _, _) in enumerate(licenses.TEMPLATES))
