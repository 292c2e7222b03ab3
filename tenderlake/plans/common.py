"""Shared analytics building blocks.

Scale notes: totals for shares are scalar subqueries (one aggregate job whose
single value is inlined), never a window over the whole table; ranking windows
are only applied to frames that are already aggregated to a bounded dimension
(countries, CPV divisions, types) or cut to a top-k first.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import cleaning as C
from ..functions.lookups import (BIDDER_BRACKETS, EXCLUDED_COUNTRY, SIZE_TIER_EDGES, SIZE_TIER_LABELS_EURO,
                                 SIZE_TIER_LABELS_PLAIN, VALUE_CAP)

# The month that the volume study compares with the months outside it.
PERIOD_START = "1998-01-01"
PERIOD_END = "1998-01-31"


def total(df: DataFrame, expr: Column | None = None) -> Column:
    """Scalar-subquery total of ``expr`` (row count by default)."""
    return df.select(F.count(F.lit(1)) if expr is None else expr).scalar()


def pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """pandas ``value_counts``: nulls dropped."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, k: int, *order: Column, partition: list[str] | None = None,
          rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows by ``order`` (ties broken by the caller's full order).

    Without a partition this is ``orderBy().limit()`` (TakeOrderedAndProject:
    each task keeps k rows, the driver merges k per task), plus a rank column.
    """
    if partition:
        w = W.partitionBy(*partition).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= k)
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank_col, F.row_number().over(W.orderBy(*order)).cast("bigint"))


def cap_value(c: str, cap: float = VALUE_CAP) -> Column:
    """Clip at ``cap`` keeping NULL (``least`` would turn NULL into the cap)."""
    return F.when(F.col(c) > cap, F.lit(cap)).otherwise(F.col(c))


CV_CLEAN_SQL = "CASE WHEN contract_value > 5000000000.0 THEN 5000000000.0 ELSE contract_value END"


def award_values(lake) -> DataFrame:
    """What the studies of notices read of the lot-grain awards: the same columns for all, so that they share them."""
    return lake.gold("gold_awards", "notice_id", "lot_result_id", "buyer_name", "buyer_country", "proc_type", "cpv_division",
                     "cpv_division_name", "contract_value", "tenders_count")


def notice_awards(lake, cap: float = VALUE_CAP) -> DataFrame:
    """Lot-grain awards collapsed to notices (value capped per lot).

    Grouped by notice and its four attributes; rows with a NULL attribute are
    dropped as the surveyed group-by does.  ``awarded_eur_total`` is 0 for
    notices whose lots have no value.
    """
    def build():
        aw = award_values(lake)
        keys = ["notice_id", "buyer_country", "proc_type", "cpv_division", "cpv_division_name"]
        cv = cap_value("contract_value", cap)
        return (aw.where(F.col("buyer_country").isNotNull() & F.col("proc_type").isNotNull()
                         & F.col("cpv_division").isNotNull() & F.col("cpv_division_name").isNotNull())
                .groupBy(*keys)
                .agg(F.coalesce(F.sum(cv), F.lit(0.0)).alias("awarded_eur_total"),
                     F.count("notice_id").alias("lot_count"),
                     F.max(cv).alias("awarded_eur_max"),
                     F.avg("tenders_count").alias("tenders_count_avg"),
                     F.max("tenders_count").alias("tenders_count_max")))
    return lake.derived("notice_awards", build, persist=True)  # the base of most studies: written once


def notice_awards_clean(lake, exclude_country: str | None = None) -> DataFrame:
    df = notice_awards(lake).where(F.col("awarded_eur_total") > 0)
    if exclude_country:
        df = df.where(F.col("buyer_country") != exclude_country)
    return df


NA_SQL = """
SELECT notice_id, buyer_country, proc_type, cpv_division, cpv_division_name,
  COALESCE(sum(CASE WHEN contract_value > 5000000000.0 THEN 5000000000.0 ELSE contract_value END), 0.0)
    AS awarded_eur_total, count(notice_id) AS lot_count,
  max(CASE WHEN contract_value > 5000000000.0 THEN 5000000000.0 ELSE contract_value END) AS awarded_eur_max, avg(tenders_count) AS tenders_count_avg,
  max(tenders_count) AS tenders_count_max
FROM gold_awards
WHERE buyer_country IS NOT NULL AND proc_type IS NOT NULL AND cpv_division IS NOT NULL
  AND cpv_division_name IS NOT NULL
GROUP BY notice_id, buyer_country, proc_type, cpv_division, cpv_division_name"""

EX = EXCLUDED_COUNTRY


bidder_bracket = C.bidder_bracket


def bracket_sql(c: str) -> str:
    parts = []
    for label, lo, hi in BIDDER_BRACKETS:
        upper = f" AND {c} < {hi}" if hi != float("inf") else ""
        parts.append(f"WHEN {c} >= {lo}{upper} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


def interval_sql(c: str, bins, closed: str = "right") -> str:
    parts = []
    for label, lo, hi in bins:
        if closed == "right":
            cond = f"{c} > {lo}" + (f" AND {c} <= {hi}" if hi != float("inf") else "")
        else:
            cond = f"{c} >= {lo}" + (f" AND {c} < {hi}" if hi != float("inf") else "")
        parts.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


def tier_sql(c: str, closed: str = "right", labels=SIZE_TIER_LABELS_EURO) -> str:
    e1, e2, e3 = (int(x) for x in SIZE_TIER_EDGES)
    l1, l2, l3, l4 = labels
    if closed == "right":
        return (f"CASE WHEN {c} IS NULL OR {c} <= 0 THEN NULL WHEN {c} <= {e1} THEN '{l1}' "
                f"WHEN {c} <= {e2} THEN '{l2}' WHEN {c} <= {e3} THEN '{l3}' ELSE '{l4}' END")
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} < {e1} THEN '{l1}' WHEN {c} < {e2} THEN '{l2}' "
            f"WHEN {c} < {e3} THEN '{l3}' ELSE '{l4}' END")


def tier_order(c: str | Column, labels=SIZE_TIER_LABELS_EURO) -> Column:
    """Ordinal (1..4) of a tier label, for ordered output."""
    v = C.col(c)
    out = F.lit(None).cast("int")
    for i, label in reversed(list(enumerate(labels, 1))):
        out = F.when(v == label, i).otherwise(out)
    return out


# Shared analytics CTEs for the DuckDB oracle.
from .oracle_base import add_ctes  # noqa: E402

add_ctes([("notice_awards", NA_SQL)])


def checkpointed(spark, df: DataFrame) -> DataFrame:
    """Snapshot ``df`` as a written Parquet table in the cluster's checkpoint
    folder (lineage cut; survives executor loss without recomputing the sort;
    computed once)."""
    from ..context import write_table
    return write_table(spark, df, "snapshot")


def global_rank(spark, df: DataFrame, order: list[Column], value: str | None = None,
                rank_col: str = "rank", running_col: str = "running", part_col: str | None = None) -> DataFrame:
    """Exact global ``row_number`` over ``order`` (and running sum of ``value``)
    without a single-partition window.

    1. ``orderBy`` range-partitions and sorts in parallel (callers include a
       unique tie-break column, so equal values spread over partitions).
    2. ``monotonically_increasing_id`` encodes (partition, position); the
       sorted frame is written once so the ids stay stable.
    3. Per-partition row counts / value sums (one row per partition, bounded by
       the shuffle partition count, hence safe to broadcast) give offsets.
    4. rank = offset + position + 1; running = offset sum + in-partition
       running sum (a window per partition, each ~N/P rows).
    """
    s = checkpointed(spark, df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumns({"_pid": F.shiftright("_mid", 33), "_pos": F.col("_mid").bitwiseAND((1 << 33) - 1)})
    aggs = [F.count(F.lit(1)).alias("_cnt")] + ([F.sum(value).alias("_vs")] if value else [])
    stats = s.groupBy("_pid").agg(*aggs)
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offs = stats.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_roff"),
                        *([F.coalesce(F.sum("_vs").over(before), F.lit(0.0)).alias("_voff")] if value else []))
    j = s.join(offs, "_pid")
    out = j.withColumn(rank_col, F.col("_roff") + F.col("_pos") + 1)
    if value:
        w = W.partitionBy("_pid").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
        out = out.withColumn(running_col, F.col("_voff") + F.sum(value).over(w))
    if part_col:
        out = out.withColumn(part_col, F.col("_pid"))
    return out.drop("_mid", "_pid", "_pos", "_roff", "_voff")


def running_by_group(spark, df: DataFrame, group: list[str], order: list[Column], value: str | None = None,
                     rank_col: str = "group_rank", running_col: str = "group_running",
                     size_col: str | None = None, total_col: str | None = None) -> DataFrame:
    """Exact per-group ``row_number`` (and running sum of ``value``) in the
    order ``order`` that stays balanced when one group holds a large share of
    the rows.

    A global ``orderBy(group, order)`` range-partitions the data, so a hot group
    is spread over many partitions instead of landing in one window task.
    Per (partition, group) counts/sums give each group's offset in every
    partition (that table has at most partitions + groups rows); inside a
    partition the window only spans that partition's share of the group.
    ``order`` must make rows unique within a group.  ``size_col`` and ``total_col`` add the group's
    rows and its sum of ``value``.
    """
    s = checkpointed(spark, df.orderBy(*[F.col(g) for g in group], *order)
                     .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumns({"_pid": F.shiftright("_mid", 33), "_pos": F.col("_mid").bitwiseAND((1 << 33) - 1)})
    aggs = [F.count(F.lit(1)).alias("_cnt")] + ([F.sum(value).alias("_vs")] if value else [])
    stats = s.groupBy("_pid", *group).agg(*aggs)
    before = W.partitionBy(*group).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offs = stats.select("_pid", *group, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_roff"),
                        *([F.coalesce(F.sum("_vs").over(before), F.lit(0)).alias("_voff")] if value else []),
                        *([F.sum("_cnt").over(W.partitionBy(*group)).alias(size_col)] if size_col else []),
                        *([F.sum("_vs").over(W.partitionBy(*group)).alias(total_col)] if total_col else []))
    j = s.join(offs, ["_pid", *group])
    w = W.partitionBy("_pid", *group).orderBy("_pos")
    out = j.withColumn(rank_col, F.col("_roff") + F.row_number().over(w))
    if value:
        out = out.withColumn(running_col, F.col("_voff") + F.sum(value).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return out.drop("_mid", "_pid", "_pos", "_roff", "_voff")


#: A selection ends by fetching the values of this many rows at most.
LAST_ROWS = 10_000
#: Accuracy of the estimates: a sketch keeps about so many values, and errs by one in so many places.
ESTIMATE = 10_000
#: Half the width of the part of the rows that the next step of a selection looks at.
MARGIN = 5e-4


def order_statistics(df: DataFrame, value: str, quantiles: list[float]) -> list[tuple | None]:
    """For each quantile the exact values at both places around (n - 1) * q and the share of the
    way between them, or None without values; nulls are left out.

    Selection by narrowing, without sorting or writing the rows: a step estimates values somewhat below
    and above the place (``percentile_approx``, a bounded sketch for each task), and counts the rows
    below, at and between them.  Rows that equal an end decide the place at once or
    leave the interval, so a value that most rows share costs nothing; an estimate that
    misses the place only repeats the step with a wider margin.  What remains, a
    thousandth of the rows each time, is fetched as (value, rows) when these are few.
    """
    v = F.col(value)
    d = df.select(v).where(v.isNotNull())

    def estimate(rows: Column, at: list[float], margin: float) -> Column:
        return F.percentile_approx(rows, [min(max(q + side, 0.0), 1.0) for q in at for side in (-margin, margin)], ESTIMATE)

    n, guess = d.agg(F.count(v), estimate(v, quantiles, MARGIN)).first()
    if not n:
        return [None] * len(quantiles)
    marks = {place: guess[2 * i:2 * i + 2] for i, q in enumerate(quantiles) for place in (math.floor((n - 1) * q), math.ceil((n - 1) * q))}
    found: dict[int, object] = {}
    # place -> (ends of its open interval, rows below it, rows in it, margin)
    todo = {place: (None, None, 0, n, MARGIN) for place in marks}

    def inside(low, high) -> Column:
        return ((v > low) if low is not None else F.lit(True)) & ((v < high) if high is not None else F.lit(True))

    while todo:
        for ends in {t[:2] for t in todo.values() if t[3] <= LAST_ROWS}:
            rows = sorted(d.where(inside(*ends)).groupBy(v).agg(F.count(v)).collect(), key=lambda r: _sort_key(r[0]))
            for place in [k for k, t in todo.items() if t[:2] == ends]:
                at = todo.pop(place)[2]
                for x, many in rows:
                    at += many
                    if place < at:
                        found[place] = x
                        break
        if not todo:
            break
        counts = []
        for place, (a, b) in marks.items():
            counts += [F.count_if(v < a), F.count_if(v == a), F.count_if(inside(a, b)), F.count_if(v == b)]
        got = d.agg(*counts).first()
        for i, (place, (a, b)) in enumerate(list(marks.items())):
            low, high, under, many, margin = todo[place]
            before, at_a, between, at_b = got[4 * i:4 * i + 4]
            if a == b:
                between, at_b = 0, 0
            if before <= place < before + at_a:
                found[place] = a
            elif before + at_a <= place < before + at_a + between:
                todo[place] = (a, b, before + at_a, between, MARGIN)
                continue
            elif before + at_a + between <= place < before + at_a + between + at_b:
                found[place] = b
            else:  # the estimate missed
                todo[place] = (low, high, under, many, 8 * margin)
                continue
            del todo[place]
        around = {}
        for place, (low, high, under, many, margin) in todo.items():
            if many > LAST_ROWS:
                around[place] = estimate(F.when(inside(low, high), v), [(place - under) / max(many - 1, 1)], margin)
        marks = dict(zip(around, d.agg(*around.values()).first())) if around else {}
    at = [(n - 1) * q for q in quantiles]
    return [(found[math.floor(p)], found[math.ceil(p)], p - math.floor(p)) for p in at]


def _sort_key(x) -> tuple:
    return (True, 0) if x != x else (False, x)  # NaN comes last, as Spark sorts


def quantiles_of(df: DataFrame, value: str, quantiles: dict[str, float]) -> dict[str, float | None]:
    """Exact interpolated quantiles {name: q} of a whole column (see :func:`order_statistics`)."""
    found = order_statistics(df, value, list(quantiles.values()))
    return {name: None if x is None else float(x[0]) + (float(x[1]) - float(x[0])) * x[2] if x[2] else float(x[0])
            for name, x in zip(quantiles, found)}


def grouped_quantiles(spark, df: DataFrame, group: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles {output column: q} of ``value`` per group, robust to a
    group, or a value, holding a large share of the rows.

    ``F.median`` and ``F.percentile`` keep a map of the group's distinct values and merge it for
    the whole group in one task; here equal values are counted first (on the map side too), the
    different ones are range-partitioned by (group, value), each learns from the bounded per-partition
    statistics which places of its group it takes, and only the one or two around each quantile
    reach the final (tiny) aggregate.
    """
    if not group:
        return spark.range(1).select(*[F.lit(x).cast("double").alias(n) for n, x in quantiles_of(df, value, quantiles).items()])
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_c"))
    r = running_by_group(spark, counted, group, [F.col(value)], value="_c", rank_col="_rk", running_col="_end", total_col="_gn")
    places = {n: (F.col("_gn") - 1) * F.lit(q) for n, q in quantiles.items()}

    def holds(place: Column) -> Column:
        return (F.col("_end") - F.col("_c") <= place) & (place < F.col("_end"))

    near = reduce(lambda x, y: x | y, [holds(F.floor(p)) | holds(F.ceil(p)) for p in places.values()])

    def between(p: Column) -> Column:
        low, high = (F.max(F.when(holds(end(p)), F.col(value))) for end in (F.floor, F.ceil))
        share = F.max(p - F.floor(p))
        return low + (high - low) * share

    return r.where(near).groupBy(*group).agg(*[between(p).alias(n) for n, p in places.items()])


def grouped_median(spark, df: DataFrame, group: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median of ``value`` per group (see :func:`grouped_quantiles`)."""
    return grouped_quantiles(spark, df, group, value, {out: 0.5})


def median_of(df: DataFrame, value: str) -> Column:
    """The exact median of a whole column, worked out now (see :func:`order_statistics`)."""
    return F.lit(quantiles_of(df, value, {"median": 0.5})["median"]).cast("double")


def with_medians(aggregated: DataFrame, rows: DataFrame, group: list[str], medians: dict[str, str]) -> DataFrame:
    """``aggregated`` (unique on ``group``) with the medians {output column: value column} of ``rows``."""
    for out, value in medians.items():
        aggregated = aggregated.join(grouped_median(rows.sparkSession, rows, group, value, out), group, "left")
    return aggregated
