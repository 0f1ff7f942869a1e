"""Time-window operators over events, for batch frames and streams where noted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from merclake.functions.columns import exact_sum, hour_bucket, seconds_between
from merclake.functions.sequence import ranged, with_run_start, with_running_last
from merclake.session import materialize


def windowed_sales(
    events: DataFrame, time_col: str = "event_timestamp", amount_col: str = "total_amount",
    length: str = "1 hour", slide: str | None = None, lateness: str = "10 minutes", by: list[str] | None = None,
) -> DataFrame:
    """Orders and revenue per time window (and ``by``); batch or stream. On a stream, rows later
    than ``lateness`` behind the newest are dropped and a window is emitted once it is closed."""
    stamped = events.withColumn(time_col, F.col(time_col).cast("timestamp"))
    if events.isStreaming:
        stamped = stamped.withWatermark(time_col, lateness)
    span = F.window(time_col, length, slide) if slide else F.window(time_col, length)
    return (
        stamped.groupBy(span.alias("w"), *(by or []))
        .agg(F.count(F.lit(1)).alias("orders"), exact_sum(amount_col).alias("revenue"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"), *(by or []), "orders", "revenue",
        )
    )


def session_windows(
    events: DataFrame, visitor_col: str = "visitor_id", time_col: str = "event_timestamp", gap_minutes: int = 30,
    lateness: str = "10 minutes",
) -> DataFrame:
    """One row per session: start, end of the last page, pages, seconds; batch or stream. A new
    session starts after more than ``gap_minutes`` without a page.

    A stream uses Spark's session window. A batch folds equal times first and then finds the
    session starts range by range, so that a visitor with most of the rows fills no single task."""
    if events.isStreaming:
        stamped = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, lateness)
        grouped = stamped.groupBy(visitor_col, F.session_window(time_col, f"{gap_minutes} minutes").alias("w")).agg(
            F.count(F.lit(1)).alias("pages"), F.max(time_col).alias("last")
        )
        start, pages = F.col("w.start"), F.col("pages")
    else:
        folded = events.groupBy(visitor_col, time_col).agg(F.count(F.lit(1)).alias("n"))
        grouped = _with_session_start(folded, visitor_col, time_col, [time_col], gap_minutes).groupBy(
            visitor_col, "session_start"
        ).agg(F.sum("n").alias("pages"), F.max(time_col).alias("last"))
        start, pages = F.col("session_start"), F.col("pages")
    return grouped.select(
        visitor_col,
        start.cast("timestamp_ntz").alias("session_start"),
        F.col("last").cast("timestamp_ntz").alias("session_end"),
        pages.alias("pages"),
        seconds_between(start, F.col("last")).alias("duration_seconds"),
    )


def _with_session_start(
    events: DataFrame, visitor_col: str, time_col: str, order: list[str], gap_minutes: int
) -> DataFrame:
    """``order`` is unique per visitor and begins with the time. The rows are stored in ranges of equal size, so a
    visitor with most of them, or most of an hour, fills no single task."""
    gap = F.expr(f"INTERVAL {gap_minutes} MINUTES")
    rows = ranged(events, [visitor_col, *order])
    return with_run_start(rows, [visitor_col], order, time_col, gap, "session_start", F.col("_range")).drop("_range")


def sessionize(
    events: DataFrame, visitor_col: str = "visitor_id", time_col: str = "event_timestamp",
    id_col: str = "page_view_id", gap_minutes: int = 30,
) -> DataFrame:
    """Rows with ``session_id`` (visitor and start time in microseconds) and ``session_start``. Rows without a
    visitor are taken as one visitor, whose sessions are named ``anonymous``.

    A visitor with most of the rows is spread over ranges; see ``functions.sequence``."""
    out = _with_session_start(events, visitor_col, time_col, [time_col, id_col], gap_minutes)
    micros = F.unix_micros(F.col("session_start").cast("timestamp")).cast("string")
    return out.withColumn("session_id", F.concat_ws("-", F.coalesce(F.col(visitor_col).cast("string"), F.lit("anonymous")), micros))


def funnel(events: DataFrame, unit_col: str, time_col: str, type_col: str, steps: list[str]) -> DataFrame:
    """Units (sessions or visitors) that reach each step in order: ``step, event_type, units,
    conversion`` (against the first step). A step counts when it happens after the unit's
    earliest time for the step before.

    The next time after a given one is looked up in two places, so that no unit's events meet
    in one task: in per-hour minima for the hours after it, and among the events of its own
    hour, which are joined by unit and hour."""
    acts = events.where(F.col(type_col).isin(steps)).select(
        unit_col, F.col(type_col).alias("_t"), F.col(time_col).alias("_at"), hour_bucket(time_col).alias("_h")
    )
    hourly = acts.groupBy(unit_col, "_t", "_h").agg(F.min("_at").alias("_at"))
    reached = hourly.where(F.col("_t") == steps[0]).groupBy(unit_col).agg(F.min("_at").alias("_r0"))
    for i, step in enumerate(steps[1:], start=1):
        # stored, so that both sides of the join are plain shuffles and Spark can split a busy unit's hour
        prev = materialize(reached.where(F.col(f"_r{i - 1}").isNotNull()).select(
            unit_col, F.col(f"_r{i - 1}").alias("_prev"), hour_bucket(f"_r{i - 1}").alias("_h")
        ))
        same_hour = (
            acts.where(F.col("_t") == step).join(prev, [unit_col, "_h"])
            .where(F.col("_at") > F.col("_prev")).select(unit_col, "_at")
        )
        after = (
            hourly.where(F.col("_t") == step).join(prev.withColumnRenamed("_h", "_ph"), unit_col)
            .where(F.col("_h") > F.col("_ph")).select(unit_col, "_at")
        )
        later = same_hour.unionByName(after).groupBy(unit_col).agg(F.min("_at").alias(f"_r{i}"))
        reached = reached.join(later, unit_col, "left")
    totals = reached.agg(*[F.count(f"_r{i}").alias(f"n{i}") for i in range(len(steps))])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"), F.lit(s).alias("event_type"), F.col(f"n{i}").alias("units"),
                F.try_divide(F.col(f"n{i}"), F.col("n0")).alias("conversion"),
            )
            for i, s in enumerate(steps)
        ]
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def last_touch(
    orders: DataFrame, touches: DataFrame, unit_col: str = "customer_id", order_time: str = "order_timestamp",
    touch_time: str = "event_timestamp", source: str | Column = "utm_source", id_col: str = "order_id",
) -> DataFrame:
    """Orders with the source of the unit's last touch before the order (``attributed_source``,
    NULL without one). A touch at the very time of the order counts as before it.

    Orders without a unit share the touches without one. See :func:`as_of`, which spreads busy units."""
    src = F.col(source) if isinstance(source, str) else source
    dated = touches.where(src.isNotNull()).select(F.col(unit_col).alias("_u"), F.col(touch_time).alias("_t"), src.cast("string").alias("attributed_source"))
    return as_of(orders, dated, {unit_col: "_u"}, order_time, "_t", id_col, match_null=True)


def as_of(
    facts: DataFrame, versions: DataFrame, keys: dict[str, str], fact_time: str, version_time: str, id_col: str, until: str | None = None,
    match_null: bool = False,
) -> DataFrame:
    """Facts with the columns of the version of their key (``{fact column: version column}``) that held at their time:
    the last one that began then or before, of equal times the largest. NULL where none had begun, or where it had
    ended (``until``, exclusive). Columns of the versions that are neither key nor time are added. A NULL key has no
    version, unless ``match_null``.

    An as-of join without a join: both sides are laid in one sequence per key and the last version is carried
    along. The sequence is stored in ranges of equal size, so a key with most of the facts fills no single task."""
    added = [c for c in versions.columns if c not in (*keys.values(), version_time, until)]
    held = F.struct(*added, *([F.col(until).alias("_until")] if until else []))
    names = [f"_k{i}" for i in range(len(keys))]
    kind = versions.select(held.alias("v")).schema["v"].dataType
    left = facts.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(fact_time).alias("_at"), F.lit(1).alias("_kind"),
        F.col(id_col).cast("string").alias("_id"), F.lit(None).cast(kind).alias("_v"), F.struct(*facts.columns).alias("_row"),
    )
    right = versions.select(
        *[F.col(k).alias(n) for k, n in zip(keys.values(), names)], F.col(version_time).alias("_at"), F.lit(0).alias("_kind"),
        (F.col(added[0]).cast("string") if len(added) == 1 and until is None else F.to_json(held)).alias("_id"), held.alias("_v"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
    )
    if not match_null:
        right = right.where(" and ".join(f"{n} is not null" for n in names))
    line = ranged(left.unionByName(right), [*names, "_at", "_kind", "_id"])
    carried = with_running_last(line, names, ["_at", "_kind", "_id"], "_v", "_held", F.col("_range")).where(F.col("_kind") == 1)
    live = F.lit(True) if until is None else F.coalesce(F.col("_held._until") > F.col("_at"), F.lit(True))
    return carried.select("_row.*", *[F.when(live, F.col(f"_held.{c}")).alias(c) for c in added])


def attribution_report(attributed: DataFrame, amount_col: str = "total_amount") -> DataFrame:
    return attributed.groupBy("attributed_source").agg(
        F.count(F.lit(1)).alias("orders"), exact_sum(amount_col).alias("revenue")
    )
