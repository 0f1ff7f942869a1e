"""Exact order statistics that no single task has to hold.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
That is fine for small groups and fatal for a global quantile over billions of
rows. Here a rank is located in two steps instead:

1. a histogram over order-preserving buckets (map-side combined, so its shuffle
   carries at most one row per bucket and task) shows which bucket holds the rank;
2. only that bucket's values are counted, spread over the cluster by value; a second
   histogram over slices of the bucket leaves one slice to sort.

Both steps are plain DataFrame operations: nothing is collected to the driver and
nothing is sampled, so the result is exact and repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from merclake.session import materialize

_SLICES = 4096  # slices of a bucket; 12 bits of the code
_STEPS_PER_E = 1024 * _SLICES  # a bucket spans a factor of e**(1/1024), about 0.1 %
_OFFSET = 800 * _STEPS_PER_E  # keeps the code of the smallest double above zero

# BIGINT, non-decreasing in _x. Its upper part is the bucket (at most about 3 million
# different ones), its lower 12 bits are the slice.
_SIZE = f"floor(ln(least(abs(_x), 1.7976931348623157e308D)) * {_STEPS_PER_E}D) + {_OFFSET}L"
_CODE = f"CASE WHEN _x > 0 THEN {_SIZE} WHEN _x < 0 THEN -({_SIZE}) ELSE 0L END"


def _targets(probs: list[float], interpolation: str) -> str:
    """SQL array of (slot, rank), ranks counted from 0, for groups of ``n`` values. Slot 2k is
    the lower value of ``probs[k]``, slot 2k+1 the upper one (linear only)."""
    slots = []
    for k, p in enumerate(probs):
        at = f"{float(p)!r}D * (n - 1)"
        if interpolation == "nearest":
            slots.append((2 * k, f"floor({at} + 0.5D)"))
        else:
            slots.append((2 * k, f"floor({at})"))
            slots.append((2 * k + 1, f"least(floor({at}) + 1, n - 1)"))
    return "array(" + ", ".join(f"struct({s} AS slot, CAST({r} AS BIGINT) AS rank)" for s, r in slots) + ")"


#: Keep the (row, rank) pairs whose rank falls into the row's run of ``_n`` positions that ends
#: at ``_upto``; the rank relative to that run is ``_rank - (_upto - _n)``.
_HOLDS = "_rank >= _upto - _n AND _rank < _upto"


def values_at(df: DataFrame, value: str, targets: str, by: list[str], few_groups: bool) -> DataFrame:
    """``(by..., slot, x, n)``: the value at each wanted rank of each group.

    ``targets`` is a SQL array of (slot, rank) over the group size ``n``.
    """
    hint = F.broadcast if few_groups else (lambda d: d)
    names = [f"`{c}`" for c in by]
    within = ", ".join(names) or "0"
    rows = (
        df.selectExpr(*names, f"CAST(`{value}` AS DOUBLE) AS _x")
        .where("_x IS NOT NULL AND NOT isnan(_x)")
        .selectExpr(*names, "_x", f"{_CODE} AS _c")
        .selectExpr(*names, "_x", "shiftright(_c, 12) AS _b", f"_c & {_SLICES - 1} AS _s")
    )
    # Per group at most as many rows as there are buckets, whatever the data size.
    buckets = (
        rows.groupBy(*by, "_b")
        .agg(F.expr("count(1) AS _n"))
        .selectExpr(
            *names, "_b", "_n",
            f"sum(_n) OVER (PARTITION BY {within} ORDER BY _b) AS _upto", f"sum(_n) OVER (PARTITION BY {within}) AS n",
        )
        .selectExpr(*names, "_b", "_n", "_upto", "n", f"inline({targets})")
        .withColumnRenamed("rank", "_rank")
        .where(_HOLDS)
        .selectExpr(*names, "slot", "_b", "_rank - (_upto - _n) AS _rank", "n")
    )
    # One row per wanted rank and group. Equal values are counted before the shuffle,
    # so ties of any size cost one row per task.
    key, keys = [*by, "slot"], [*names, "slot"]
    counted = (
        rows.join(hint(buckets), [*by, "_b"]).groupBy(*key, "_rank", "n", "_s", "_x").agg(F.expr("count(1) AS _n"))
    )
    # At most 4096 rows per wanted rank.
    slices = (
        counted.groupBy(*key, "_rank", "n", "_s")
        .agg(F.expr("sum(_n) AS _n"))
        .selectExpr(*keys, "_s", "_rank", "_n", f"sum(_n) OVER (PARTITION BY {', '.join(keys)} ORDER BY _s) AS _upto")
        .where(_HOLDS)
        .selectExpr(*keys, "_s", "_rank - (_upto - _n) AS _rank")
    )
    return (
        counted.drop("_rank")
        .join(hint(slices), [*key, "_s"])
        .selectExpr(
            *keys, "n", "_x AS x", "_rank", "_n", f"sum(_n) OVER (PARTITION BY {', '.join(keys)} ORDER BY _x) AS _upto"
        )
        .where(_HOLDS)
        .select(*key, "x", "n")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    interpolation: str = "linear",
    few_groups: bool = False,
) -> DataFrame:
    """``(by..., n, q array<double>)`` with one quantile per entry of ``probs``.

    ``interpolation`` is ``linear`` (between the two neighbouring values),
    ``nearest`` (the value at rank ``floor(p*(n-1)+0.5)``) or ``approx`` (a
    sketch: one pass, rank error at most 1/10000). NULL and NaN are left out.

    ``few_groups=True`` states that the number of groups is bounded by
    construction (a fixed list of metric names, say), which allows a broadcast.
    """
    by = list(by or [])
    names = [f"`{c}`" for c in by]
    if interpolation == "approx":
        clean = df.selectExpr(*names, f"CAST(`{value}` AS DOUBLE) AS _x").where("_x IS NOT NULL AND NOT isnan(_x)")
        return clean.groupBy(*by).agg(
            F.expr("count(1) AS n"), F.percentile_approx("_x", [float(p) for p in probs], 10000).alias("q")
        )
    if interpolation not in ("linear", "nearest"):
        raise ValueError(f"unknown interpolation: {interpolation}")
    found = values_at(df, value, _targets(probs, interpolation), by, few_groups or not by)
    at = lambda slot: f"max(CASE WHEN slot = {slot} THEN x END)"
    if interpolation == "nearest":
        q = [at(2 * k) for k in range(len(probs))]
    else:
        part = lambda p: f"({float(p)!r}D * (max(n) - 1) - floor({float(p)!r}D * (max(n) - 1)))"
        q = [
            f"{at(2 * k)} + ({at(2 * k + 1)} - {at(2 * k)}) * {part(p)}" for k, p in enumerate(probs)
        ]
    return found.groupBy(*by).agg(F.expr("max(n) AS n"), F.expr(f"array({', '.join(q)}) AS q"))


def cuts(df: DataFrame, probs: dict[str, list[float]], interpolation: str = "nearest") -> dict[str, list[float | None]]:
    """The quantiles of several columns as numbers, ``None`` where a column has no value.

    The values alone are stored once and searched in one go, so ``df`` is read once here however often the search
    reads its values, and what uses the numbers has a plan without any trace of the search."""
    cells = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in probs)
    values = materialize(df.selectExpr(f"stack({len(probs)}, {cells}) AS (m, v)").where("v IS NOT NULL"))
    every = sorted({p for ps in probs.values() for p in ps})
    found = exact_quantiles(values, "v", every, by=["m"], interpolation=interpolation, few_groups=True)
    rows = {r["m"]: r["q"] for r in found.collect()}  # one row for each column
    return {c: [rows[c][every.index(p)] if c in rows else None for p in ps] for c, ps in probs.items()}


def cuts_of_each(frames: dict[str, DataFrame], probs: dict[str, list[float]], interpolation: str = "nearest") -> dict[str, dict[str, list[float | None]]]:
    """:func:`cuts` of several frames with the same columns, found in one search."""
    apart = lambda frame: [F.col(c).cast("double").alias(f"{frame}/{c}") for c in probs]
    parts = [
        df.select(*[col for name in frames for col in (apart(name) if name == own else [F.lit(None).cast("double").alias(f"{name}/{c}") for c in probs])])
        for own, df in frames.items()
    ]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    found = cuts(rows, {f"{name}/{c}": ps for name in frames for c, ps in probs.items()}, interpolation)
    return {name: {c: found[f"{name}/{c}"] for c in probs} for name in frames}


def smallest_share(
    df: DataFrame, value: str, share: float, by: list[str], few_groups: bool = False
) -> DataFrame:
    """``(by..., n, cut)``: the value at rank ``ceil(share*n)`` (counted from 1), so that
    ``value <= cut`` keeps exactly that many rows of each group when values differ."""
    pick = f"array(struct(0 AS slot, CAST(ceil({float(share)!r}D * n) - 1 AS BIGINT) AS rank))"
    found = values_at(df, value, pick, by, few_groups or not by)
    return found.select(*by, "n", F.col("x").alias("cut"))
