"""Every stage of the pipeline against brute force on its own input, over planted documents and a given table."""

import random

import pytest
from test_decontam import slow as slow_overlaps
from test_mixing import plain
from test_near_dup import slow_components, slow_print
from test_suffix_dedup import slow as slow_repeats

import corpus_pipeline as cp
from merclake.llm.common import store

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))


def walk(spark, docs, sf_dir):
    """Run the stages one after the other and compare each with what it should give."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in cp.STAGES:
        before = rows_of(docs)
        docs = store(stage(spark, docs, sf_dir), name)
        if name != "mixing":
            assert docs.columns == cp_columns(before, docs)
        after = docs.collect() if name == "mixing" else rows_of(docs)
        ids = [r["doc_id"] for r in before]
        if name == "language_id":
            want = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
            assert after == want
        elif name == "near_duplicates":
            roots = slow_components([slow_print(r["text"]) for r in before], ids)
            gone = {d for d, root in zip(ids, roots) if d is not None and d != root}
            assert after == [r for r in before if r["doc_id"] not in gone] and gone
        elif name == "repeated_strings":
            kept = {(r[0], r[5]) for r in slow_repeats([(r["doc_id"], r["text"]) for r in before])}
            assert {(str(r["doc_id"]), r["text"] or "") for r in after} == {k for k in kept if k[1]}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "decontamination":
            bad = {r[0] for r in slow_overlaps([(r["doc_id"], r["text"]) for r in before], items)}
            assert after == [r for r in before if str(r["doc_id"]) not in bad] and bad
        else:
            want = plain([(r["doc_id"], r["text"], None, r["source"]) for r in before])
            taken = {}
            for r in after:
                taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["words"]
            assert taken == {d: k for d, _, _, k in want if k}
            assert [r["position"] for r in after] == sorted(r["position"] for r in after)
    return docs


def cp_columns(before, docs):
    return list(before[0].asDict()) if before else docs.columns


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    end = walk(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    again = cp.run(spark, sf)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, end.collect()))


@pytest.fixture()
def planted(spark):
    rng = random.Random(9)
    words = ["the", "and", "of", "ther", "ing", "tion", "en", "der", "die", "und", "sch", "ung"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    shared, leak = prose(60), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first()["text"]
    base = [prose(120) for _ in range(12)]
    texts = [*base, base[0], base[1], base[1] + " one more", None, "", "12 34 !!", prose(30) + " " + shared, prose(40) + shared + prose(5), leak + " " + prose(30), prose(20) + " " + leak, "ü" * 200, "long " * 20000]
    return [(i + 10, t, rng.choice(["en", "de", None]), f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]


def test_planted_documents(spark, planted):
    sf = "/root/testdata/sf0.001"
    walk(spark, spark.createDataFrame(planted, SCHEMA), sf)


def test_repeated_rows_nulls_and_further_columns(spark, planted):
    """Stages stand repeated rows, a row without doc_id and columns with names that they use themselves."""
    from pyspark.sql import functions as F

    rows = [*planted, *planted[:3], (None, "a row without id " * 9, "en", "s1", 153)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("kept", "held_out", "score", "spans", "place", "kind", "data", "rest", "fp", "size")})
    columns = docs.columns
    for name, stage in cp.STAGES[:-1]:
        docs = store(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == columns and docs.where("doc_id IS NULL").count() == 1
    assert cp.STAGES[-1][1](spark, docs, "").count() > 0


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in cp.STAGES:
        docs = store(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.count() == 0
