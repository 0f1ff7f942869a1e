"""Mixing sources to target weights along a time-varying curriculum.

Targets. The sources, ordered by code point with null last, take the weights of a repeating cycle and share a given
multiple of all words. A target stops at a multiple of its source's size; the excess goes to the others by weight
until none is above. That water level is found by rounds over the table of sources; three numbers a round go to the
driver.

Curriculum. A source's words are read in the order of a hash of the document id, in as many passes as the target
needs; the last pass stops inside a document. Its weight schedule says how strongly it is drawn at each time in
[0, 1]. The integral of the schedule is its cumulative demand; inverted at the middle of a document's words it gives
the document's training position. Documents are then range-sorted by position.

Prefix sums. A source may hold any share of the rows, so it is cut into buckets by the leading hash digits: words
before a bucket come from a table of bucket sums, words before a document from a window inside its bucket.

Defined results: null and empty texts have size 0 and are never taken. Null and empty sources are two sources. Rows
that repeat a doc_id are documents of their own; where they also equal in size, they share the taken words in
any order. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merclake.llm.common import documents, indexed, small_batches, store, text_bytes
from merclake.llm.registry import query

WEIGHTS = (5, 2, 1)
#: For each place in the cycle of weights, the knots (time, strength) of its schedule: what weighs most is drawn
#: early, what weighs least late.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.75, 1.0), (1.0, 2.5)),
)
#: Leading hexadecimal digits of the hash that make a bucket of a source.
DIGITS = 3


def word_count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text by the number of its words between white space."""
    for batch in batches:
        sizes = pa.array([len(x.split()) for x in text_bytes(batch.column("text"))], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), sizes], ["doc_id", "source", "size"])


def targets(sources: DataFrame, share: tuple[int, int] = (3, 2), most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``weight``, ``place`` (in the cycle) and ``target`` to a table (source, source_size). ``share`` is the
    fraction of all words that the sources share, ``most`` the multiple of its size at which a target stops."""
    up, down = share
    ranked = indexed(sources, [F.col("source").isNull(), F.col("source")], "nth")
    place = F.col("nth") % len(weights)
    weight = F.array(*[F.lit(w) for w in weights])[place.cast("int")].cast("long")
    ranked = store(ranked.withColumn("place", place.cast("int")).withColumn("weight", weight), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    capped_words, free_weight = 0, ranked.agg(F.sum("weight")).first()[0] or 0
    while free_weight:  # each round raises the level, so that more sources may reach their limit
        above = F.col("weight") * F.lit(up * total - down * capped_words) > F.lit(down * most * free_weight) * F.col("source_size")
        row = ranked.agg(
            F.sum(F.when(above, F.col("source_size") * most)).alias("words"), F.sum(F.when(~above, F.col("weight"))).alias("free")
        ).first()
        if (row["words"] or 0) == capped_words and (row["free"] or 0) == free_weight:
            break
        capped_words, free_weight = row["words"] or 0, row["free"] or 0
    if free_weight:
        level = F.col("weight") * F.lit(up * total - down * capped_words) / F.lit(float(down * free_weight))
        target = F.least(level, (F.col("source_size") * most).cast("double"))
    else:
        target = (F.col("source_size") * most).cast("double")
    return ranked.select("source", "source_size", "place", "weight", target.alias("target"))


def invert_demand(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """Time at which a source with this schedule has drawn ``share`` (0 to 1) of its demand. The schedule is linear
    between knots, its integral quadratic."""
    pieces, area = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:]):
        pieces.append((t0, t1, a, b, area))
        area += (a + b) / 2 * (t1 - t0)
    result: Column | None = None
    for t0, t1, a, b, before in reversed(pieces):
        need = share * area - before  # a*x + slope/2*x*x = need
        slope = (b - a) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(a * a) + need * (2 * slope), F.lit(0.0)))
        time = F.lit(t0) + need * 2 / (root + a)
        time = F.least(F.greatest(time, F.lit(t0)), F.lit(t1))
        result = time if result is None else F.when(share * area <= before + (a + b) / 2 * (t1 - t0), time).otherwise(result)
    return result


def mix(docs: DataFrame, seed: str = "mix", schedules=SCHEDULES, **how) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, taken, and ``passes``, an array of
    (pass, words, position), one for each time that the document is read. ``how`` goes to ``targets``."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "source", "text").mapInArrow(word_count, f"doc_id {kind}, source string, size long")
    order = F.md5(F.concat_ws("-", F.lit(seed), F.col("doc_id").cast("string")))
    counted = store(counted.withColumn("key", order), "sizes")
    bucket = F.substring("key", 1, DIGITS)
    buckets = store(counted.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "buckets")
    sources = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), **how)
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("start", F.coalesce(F.sum("words").over(running), F.lit(0))).drop("words")
    # few rows for a source: sources and bucket sums meet first, then one join with the documents
    buckets = buckets.withColumnRenamed("source", "s").withColumnRenamed("bucket", "b")
    starts = buckets.join(sources, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    rows = counted.withColumn("bucket", bucket)
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).drop("s", "b")
    inner = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("size").over(inner), F.lit(0))
    wanted = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    rows = rows.withColumn("before", before).withColumn("wanted", wanted).withColumn("whole", whole)
    extra = F.least(F.greatest(F.col("wanted") - F.col("whole") * F.col("source_size") - F.col("before"), F.lit(0)), F.col("size"))
    rows = rows.withColumn("extra", extra)

    def position(p: Column, words: Column) -> Column:
        share = (p * F.col("source_size") + F.col("before") + words / 2) / F.col("wanted")
        chosen = invert_demand(share, schedules[-1])
        for i, knots in enumerate(schedules[:-1]):
            chosen = F.when(F.col("place") % len(schedules) == i, invert_demand(share, knots)).otherwise(chosen)
        return chosen

    def one(p: Column, words: Column) -> Column:
        return F.struct(p.cast("int").alias("pass"), words.alias("words"), position(p, words).alias("position"))

    full = F.when(
        (F.col("whole") > 0) & (F.col("size") > 0),
        F.transform(F.sequence(F.lit(0), F.col("whole").cast("int") - 1), lambda p: one(p, F.col("size"))),
    ).otherwise(F.array().cast("array<struct<pass:int,words:bigint,position:double>>"))
    last = F.when(F.col("extra") > 0, F.array(one(F.col("whole"), F.col("extra")))).otherwise(
        F.array().cast("array<struct<pass:int,words:bigint,position:double>>")
    )
    taken = (F.col("whole") * F.col("size") + F.col("extra")).cast("long")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), F.concat(full, last).alias("passes")
    )


def curriculum(mixed: DataFrame) -> DataFrame:
    """The mix with one row for each document, range-sorted by the position of its first pass; documents that are never
    read come last. Repeats of equal columns stand in any order."""
    first = F.get("passes", F.lit(0))["position"]
    return mixed.orderBy(first.asc_nulls_last(), "doc_id", "size")


def training_order(mixed: DataFrame) -> DataFrame:
    """The mix as it is read: one row for each pass of a document, range-sorted by training position."""
    rows = mixed.select("doc_id", "source", "size", "source_size", "target", "taken", F.explode("passes").alias("p"))
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "taken", "p.pass", "p.words", "p.position")
    return rows.orderBy("position", "doc_id", "pass")


def _inverse_sql(knots: tuple[tuple[float, float], ...]) -> str:
    """The same as ``invert_demand`` of a column ``share``, in SQL."""
    number = lambda x: f"CAST({x!r} AS DOUBLE)"
    area = sum((a + b) / 2 * (t1 - t0) for (t0, a), (t1, b) in zip(knots, knots[1:]))
    cases, before = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:]):
        need, slope = f"(share * {number(area)} - {number(before)})", (b - a) / (t1 - t0)
        root = f"sqrt(greatest({number(a * a)} + {need} * {number(2 * slope)}, CAST(0 AS DOUBLE)))"
        time = f"least(greatest({number(t0)} + {need} * 2 / ({root} + {number(a)}), {number(t0)}), {number(t1)})"
        before += (a + b) / 2 * (t1 - t0)
        cases.append((f"share * {number(area)} <= {number(before)}", time))
    return "CASE " + " ".join(f"WHEN {test} THEN {time}" for test, time in cases[:-1]) + f" ELSE {cases[-1][1]} END" if cases[1:] else cases[0][1]


SQL = """WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS size,
 md5('mix-' || doc_id) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) AS place FROM s),
r AS (SELECT *, CAST([5, 2, 1][place + 1] AS BIGINT) AS weight FROM n),
o AS (SELECT *, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY source_size / CAST(weight AS DOUBLE), source) AS k FROM r),
c AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
 sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o),
l AS (SELECT min(k) AS k FROM c WHERE weight * (3 * total - 2 * capped) <= 4 * free * source_size),
v AS (SELECT CAST(3 * total - 2 * capped AS BIGINT) AS num, CAST(free AS BIGINT) AS free FROM c JOIN l USING (k)),
t AS (SELECT source, source_size, place, least(weight * num / CAST(2 * free AS DOUBLE), CAST(2 * source_size AS DOUBLE)) AS target FROM r, v),
p AS (SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, place, target, CAST(floor(target + 0.5) AS BIGINT) AS wanted,
 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
 FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
w AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE wanted // source_size END AS whole FROM p),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(greatest(wanted - whole * source_size - before, 0), size) END AS extra FROM w),
f AS (SELECT *, CAST(before + CAST(CASE WHEN whole > 0 THEN size ELSE extra END AS DOUBLE) / 2 AS DOUBLE) / wanted AS share FROM e)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(whole * size + extra AS BIGINT) AS taken,
 CASE WHEN whole * size + extra = 0 THEN NULL """ + " ".join(f"WHEN place = {i} THEN {_inverse_sql(knots)}" for i, knots in enumerate(SCHEDULES)) + " END AS position FROM f"


@query("op7_mixing", SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents in the order of the curriculum, with the training position of their first pass; those never read
    have none and come last."""
    first = F.get("passes", F.lit(0))["position"].alias("position")
    return curriculum(mix(documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", "taken", first)
