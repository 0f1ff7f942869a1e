"""The registered query gives the documents in the order of the curriculum."""

from merclake.llm import mixing
from merclake.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_query_follows_the_positions(spark):
    first = {}
    for r in mixing.training_order(mixing.mix(documents(spark, SF))).collect():
        first.setdefault(r["doc_id"], r["position"])
    got = [r["doc_id"] for r in mixing.op7_mixing(spark, SF).collect()]
    assert len(first) > 10 and len(got) == len(set(got))
    assert got == sorted(got, key=lambda d: (first.get(d, 2.0), d))
