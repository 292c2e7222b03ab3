"""Competition study (O-CMP-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.lookups import BIDDER_BRACKETS, MARKET_TIERS, SAVINGS_BRACKETS, SIZE_TIER_LABELS_PLAIN
from ..registry import query
from . import common as K

CV = K.CV_CLEAN_SQL
EX = K.EX
# FIXED VALUES: second country excluded from the competition-savings match, and
# the spotlight CPV divisions.
EXCLUDED_SAVINGS_COUNTRY = "CHE"
SPOTLIGHT_DIVISIONS = ("72", "48")
SPOTLIGHT_FOCUS = "72"

TC = "tenders_count_avg"


def _with_bidders(lake) -> DataFrame:
    return K.notice_awards(lake).where(F.col(TC).isNotNull())


def _intensity(df: DataFrame, keys: list, *, solo=True, high=False, contested=False) -> DataFrame:
    aggs = [F.median(TC).alias("median_bidders"), F.avg(TC).alias("mean_bidders"),
            F.count("notice_id").alias("n_notices")]
    if contested:
        aggs.append((F.avg((F.col(TC) > 1).cast("double")) * 100).alias("pct_contested"))
    if solo:
        aggs.append((F.avg((F.col(TC) <= 1).cast("double")) * 100).alias("pct_solo"))
    if high:
        aggs.append((F.avg((F.col(TC) >= 5).cast("double")) * 100).alias("pct_high"))
    return df.groupBy(*keys).agg(*aggs)


@query("bidder_audit", sql="""
SELECT count(*) AS n_lots, count(tenders_count) AS n_valid, count(*) - count(tenders_count) AS n_null,
  count(*) FILTER (WHERE tenders_count = 0) AS n_zero,
  min(tenders_count) FILTER (WHERE tenders_count > 0) AS min_positive,
  median(tenders_count) FILTER (WHERE tenders_count > 0) AS median_positive,
  avg(tenders_count) FILTER (WHERE tenders_count > 0) AS mean_positive,
  max(tenders_count) FILTER (WHERE tenders_count > 0) AS max_positive,
  quantile_cont(tenders_count, 0.9) FILTER (WHERE tenders_count > 0) AS p90_positive,
  quantile_cont(tenders_count, 0.95) FILTER (WHERE tenders_count > 0) AS p95_positive
FROM gold_awards""")
def bidder_audit(lake):
    """Bidder-count audit over award lots: valid / null / zero; distribution of positives."""
    aw = lake.gold("gold_awards")
    pos = F.when(F.col("tenders_count") > 0, F.col("tenders_count"))
    return aw.agg(F.count(F.lit(1)).alias("n_lots"), F.count("tenders_count").alias("n_valid"),
                  F.count_if(F.col("tenders_count").isNull()).alias("n_null"),
                  F.count_if(F.col("tenders_count") == 0).alias("n_zero"),
                  F.min(pos).alias("min_positive"), F.median(pos).alias("median_positive"),
                  F.avg(pos).alias("mean_positive"), F.max(pos).alias("max_positive"),
                  F.percentile(pos, 0.9).alias("p90_positive"), F.percentile(pos, 0.95).alias("p95_positive"))


@query("bidder_coverage", sql="""
SELECT 'buyer_country' AS dimension, buyer_country AS value, CAST(NULL AS VARCHAR) AS value_label,
  count(*) AS total_lots, count(tenders_count) AS valid_tc, avg(tenders_count) AS mean_tc,
  median(tenders_count) AS median_tc, count(tenders_count) * 100.0 / count(*) AS pct_coverage
FROM gold_awards WHERE buyer_country IS NOT NULL GROUP BY buyer_country HAVING count(*) >= 50
UNION ALL
SELECT 'proc_type', proc_type, NULL, count(*), count(tenders_count), avg(tenders_count), median(tenders_count),
  count(tenders_count) * 100.0 / count(*) FROM gold_awards WHERE proc_type IS NOT NULL GROUP BY proc_type
UNION ALL
SELECT 'cpv_division', cpv_division, cpv_division_name, count(*), count(tenders_count), avg(tenders_count),
  median(tenders_count), count(tenders_count) * 100.0 / count(*) FROM gold_awards
WHERE cpv_division IS NOT NULL AND cpv_division_name IS NOT NULL GROUP BY 2, 3 HAVING count(*) >= 100""")
def bidder_coverage(lake):
    """Bidder-count coverage and level by country (>= 50 lots), type, CPV (>= 100 lots)."""
    aw = lake.gold("gold_awards")
    parts = []
    for dim, label, min_n in (("buyer_country", None, 50), ("proc_type", None, 0),
                              ("cpv_division", "cpv_division_name", 100)):
        keys = [F.col(dim).alias("value")] + ([F.col(label).alias("value_label")] if label else [])
        base = aw.where(F.col(dim).isNotNull() & (F.col(label).isNotNull() if label else F.lit(True)))
        g = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_lots"), F.count("tenders_count").alias("valid_tc"),
                                    F.avg("tenders_count").alias("mean_tc"), F.median("tenders_count").alias("median_tc"))
        if not label:
            g = g.withColumn("value_label", F.lit(None).cast("string"))
        g = g.where(F.col("total_lots") >= min_n) if min_n else g
        parts.append(g.select(F.lit(dim).alias("dimension"), "value", "value_label", "total_lots", "valid_tc",
                              "mean_tc", "median_tc",
                              (F.col("valid_tc") * 100.0 / F.col("total_lots")).alias("pct_coverage")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("competition_by_country", sql="""
SELECT buyer_country, median(tenders_count_avg) AS median_bidders, avg(tenders_count_avg) AS mean_bidders,
  count(notice_id) AS n_notices, avg(CASE WHEN tenders_count_avg > 1 THEN 1.0 ELSE 0.0 END) * 100 AS pct_contested
FROM notice_awards WHERE tenders_count_avg IS NOT NULL GROUP BY buyer_country HAVING count(notice_id) >= 20""")
def competition_by_country(lake):
    """Median / mean bidders per notice by country (>= 20 notices), % contested."""
    g = _intensity(_with_bidders(lake), ["buyer_country"], solo=False, contested=True)
    return g.where(F.col("n_notices") >= 20).orderBy(F.col("median_bidders").desc(), "buyer_country")


def _bracket_sql(c: str) -> str:
    return K.bracket_sql(c)


@query("bidder_brackets", sql=f"""
WITH t AS (SELECT tenders_count_avg AS v FROM notice_awards WHERE tenders_count_avg IS NOT NULL),
b AS (SELECT {_bracket_sql('v')} AS bracket, count(*) AS n FROM t GROUP BY 1),
labels AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{label}')" for i, (label, _, _) in enumerate(BIDDER_BRACKETS, 1))})
           x(bracket_order, bracket))
SELECT labels.bracket_order, labels.bracket, COALESCE(n, 0) AS n_notices,
  COALESCE(n, 0) * 100.0 / (SELECT count(*) FROM t) AS pct_notices,
  (SELECT median(v) FROM t) AS overall_median, (SELECT avg(v) FROM t) AS overall_mean,
  (SELECT avg(CASE WHEN v <= 1 THEN 1.0 ELSE 0.0 END) * 100 FROM t) AS overall_pct_solo,
  (SELECT avg(CASE WHEN v >= 5 THEN 1.0 ELSE 0.0 END) * 100 FROM t) AS overall_pct_5plus
FROM labels LEFT JOIN b ON b.bracket = labels.bracket""")
def bidder_brackets(lake):
    """Notices per bidder bracket (left-closed edges 1/1.5/3.5/5.5/10.5) + overall stats."""
    t = _with_bidders(lake).select(F.col(TC).alias("v"))
    b = t.groupBy(C.bidder_bracket("v").alias("bracket")).agg(F.count(F.lit(1)).alias("n"))
    labels = lake.spark.createDataFrame([(i, label) for i, (label, _, _) in enumerate(BIDDER_BRACKETS, 1)],
                                        "bracket_order int, bracket string")
    stats = t.agg(F.count(F.lit(1)).alias("_n"), F.median("v").alias("overall_median"),
                  F.avg("v").alias("overall_mean"),
                  (F.avg((F.col("v") <= 1).cast("double")) * 100).alias("overall_pct_solo"),
                  (F.avg((F.col("v") >= 5).cast("double")) * 100).alias("overall_pct_5plus"))
    joined = labels.join(b, "bracket", "left").withColumn("n_notices", F.coalesce("n", F.lit(0)))
    return joined.select(
        "bracket_order", "bracket", "n_notices",
        (F.col("n_notices") * 100.0 / stats.select("_n").scalar()).alias("pct_notices"),
        stats.select("overall_median").scalar().alias("overall_median"),
        stats.select("overall_mean").scalar().alias("overall_mean"),
        stats.select("overall_pct_solo").scalar().alias("overall_pct_solo"),
        stats.select("overall_pct_5plus").scalar().alias("overall_pct_5plus"))


@query("competition_by_cpv", sql="""
WITH g AS (SELECT cpv_division, cpv_division_name, median(tenders_count_avg) AS median_bidders,
             avg(tenders_count_avg) AS mean_bidders, count(notice_id) AS n_notices,
             avg(CASE WHEN tenders_count_avg <= 1 THEN 1.0 ELSE 0.0 END) * 100 AS pct_solo
           FROM notice_awards WHERE tenders_count_avg IS NOT NULL GROUP BY 1, 2 HAVING count(notice_id) >= 20),
r AS (SELECT *, row_number() OVER (ORDER BY median_bidders DESC, cpv_division) AS rank, count(*) OVER () AS n FROM g)
SELECT cpv_division, cpv_division_name, median_bidders, mean_bidders, n_notices, pct_solo, rank,
  rank <= 15 AS is_top15, rank > n - 15 AS is_bottom15 FROM r""")
def competition_by_cpv(lake):
    """Bidders by CPV division (>= 20 notices), % solo; top and bottom 15 flagged."""
    g = _intensity(_with_bidders(lake), ["cpv_division", "cpv_division_name"]).where(F.col("n_notices") >= 20)
    # One row per CPV division: a bounded dimension, so a global window is cheap here.
    w = W.orderBy(F.col("median_bidders").desc(), "cpv_division")
    r = g.withColumn("rank", F.row_number().over(w).cast("bigint"))
    n = K.total(g)
    return r.withColumns({"is_top15": F.col("rank") <= 15, "is_bottom15": F.col("rank") > n - 15})


@query("competition_by_type", sql="""
SELECT proc_type, median(tenders_count_avg) AS median_bidders, avg(tenders_count_avg) AS mean_bidders,
  count(notice_id) AS n_notices, avg(CASE WHEN tenders_count_avg <= 1 THEN 1.0 ELSE 0.0 END) * 100 AS pct_solo,
  avg(CASE WHEN tenders_count_avg >= 5 THEN 1.0 ELSE 0.0 END) * 100 AS pct_high
FROM notice_awards WHERE tenders_count_avg IS NOT NULL GROUP BY proc_type""")
def competition_by_type(lake):
    """Bidders by procurement type with % solo and % high (>= 5)."""
    return _intensity(_with_bidders(lake), ["proc_type"], high=True).orderBy(F.col("median_bidders").desc())


def competition_savings(lake, trim: float = 200.0) -> DataFrame:
    """Notices with bidders, estimate and award (two countries excluded), trimmed."""
    aw = lake.gold("gold_awards").withColumn("cv_clean", K.cap_value("contract_value"))
    lots = aw.where(F.col("tenders_count").isNotNull() & F.col("estimated").isNotNull()
                    & F.col("cv_clean").isNotNull() & (F.col("cv_clean") > 0) & (F.col("estimated") > 0))
    keys = ["notice_id", "buyer_country", "proc_type", "cpv_division", "cpv_division_name"]
    g = (lots.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).groupBy(*keys)
         .agg(F.sum("estimated").alias("estimated_total"), F.sum("cv_clean").alias("awarded_total"),
              F.avg("tenders_count").alias(TC)))
    g = g.where((F.col("estimated_total") > 0) & (F.col("awarded_total") > 0)
                & (F.col("buyer_country") != EX) & (F.col("buyer_country") != EXCLUDED_SAVINGS_COUNTRY))
    g = g.withColumn("savings_pct", (F.col("estimated_total") - F.col("awarded_total")) / F.col("estimated_total") * 100)
    return g.where((F.col("savings_pct") >= -trim) & (F.col("savings_pct") <= trim))


COMP_SAV_SQL = f"""cs AS (
SELECT * FROM (
  SELECT *, (estimated_total - awarded_total) / estimated_total * 100 AS savings_pct
  FROM (SELECT notice_id, buyer_country, proc_type, cpv_division, cpv_division_name, sum(estimated) AS estimated_total,
          sum({CV}) AS awarded_total, avg(tenders_count) AS tenders_count_avg
        FROM gold_awards
        WHERE tenders_count IS NOT NULL AND estimated IS NOT NULL AND contract_value IS NOT NULL AND {CV} > 0
          AND estimated > 0 AND buyer_country IS NOT NULL AND proc_type IS NOT NULL AND cpv_division IS NOT NULL
          AND cpv_division_name IS NOT NULL
        GROUP BY 1, 2, 3, 4, 5)
  WHERE estimated_total > 0 AND awarded_total > 0 AND buyer_country <> '{EX}' AND buyer_country <> '{EXCLUDED_SAVINGS_COUNTRY}')
WHERE savings_pct BETWEEN -200 AND 200)"""


def average_rank(spark, df: DataFrame, col: str, out: str) -> DataFrame:
    """Average (fractional) rank of ``col``, ties share the mean of their positions.

    The rows are sorted in parallel, ties broken by a hash of the row, so that a value that
    holds a third of the rows lies in many partitions.  Each partition tells every value's first and
    last place in it (one row per partition and value); a value's first and last place
    of all are the smallest and largest of those, and go back to the rows by (partition, value): no
    task gets all rows of a value.  NULLs get no rank.
    """
    known = df.where(F.col(col).isNotNull())
    ranked = K.global_rank(spark, known, [F.col(col), F.xxhash64(*[F.col(c) for c in df.columns])], rank_col="_at", part_col="_part")
    places = ranked.groupBy("_part", col).agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    value = W.partitionBy(col)
    means = places.select("_part", col, ((F.min("_from").over(value) + F.max("_to").over(value)) / 2.0).alias(out))
    out_rows = ranked.join(means, ["_part", col]).select(*df.columns, out)
    return out_rows.unionByName(df.where(F.col(col).isNull()).withColumn(out, F.lit(None).cast("double")))


@query("competition_savings_corr", sql=f"""WITH {COMP_SAV_SQL},
rk AS (SELECT tenders_count_avg AS x, savings_pct AS y,
         rank() OVER (ORDER BY tenders_count_avg) + (count(*) OVER (PARTITION BY tenders_count_avg) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY savings_pct) + (count(*) OVER (PARTITION BY savings_pct) - 1) / 2.0 AS ry FROM cs)
SELECT count(*) AS n, corr(x, y) AS pearson, corr(rx, ry) AS spearman FROM rk""")
def competition_savings_corr(lake):
    """Pearson and Spearman correlation of bidders vs savings on the matched set."""
    cs = competition_savings(lake).select(F.col(TC).alias("x"), F.col("savings_pct").alias("y"))
    ranked = average_rank(lake.spark, average_rank(lake.spark, cs, "x", "rx"), "y", "ry")
    return ranked.agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("pearson"),
                      F.corr("rx", "ry").alias("spearman"))


@query("savings_by_bracket", sql=f"""WITH {COMP_SAV_SQL}
SELECT * FROM (SELECT {K.interval_sql(TC, SAVINGS_BRACKETS)} AS comp_bracket, median(savings_pct) AS median_savings,
  avg(savings_pct) AS mean_savings, count(notice_id) AS n_contracts FROM cs GROUP BY 1) WHERE comp_bracket IS NOT NULL""")
def savings_by_bracket(lake):
    """Savings by competition bracket (right-closed 0/1.5/3.5/5.5/10.5)."""
    cs = competition_savings(lake).withColumn("comp_bracket", C.interval_label(TC, SAVINGS_BRACKETS))
    cs = cs.where(F.col("comp_bracket").isNotNull())
    g = cs.groupBy("comp_bracket").agg(F.avg("savings_pct").alias("mean_savings"), F.count("notice_id").alias("n_contracts"))
    return K.with_medians(g, cs, ["comp_bracket"], {"median_savings": "savings_pct"})


@query("savings_bracket_type", sql=f"""WITH {COMP_SAV_SQL}
SELECT * FROM (SELECT {K.interval_sql(TC, SAVINGS_BRACKETS)} AS comp_bracket, proc_type,
  CAST(round_even(CAST(median(savings_pct) AS DECIMAL(38,14)), 1) AS DOUBLE) AS median_savings FROM cs GROUP BY 1, 2)
WHERE comp_bracket IS NOT NULL""")
def savings_bracket_type(lake):
    """Median savings by competition bracket x procurement type (long form of the pivot)."""
    cs = competition_savings(lake).withColumn("comp_bracket", C.interval_label(TC, SAVINGS_BRACKETS))
    m = K.grouped_median(lake.spark, cs.where(F.col("comp_bracket").isNotNull()), ["comp_bracket", "proc_type"], "savings_pct",
                         "median_savings")
    return m.withColumn("median_savings", F.bround(F.col("median_savings").cast("decimal(38,14)"), 1).cast("double"))


@query("competition_by_size", sql=f"""
SELECT * FROM (SELECT {K.tier_sql('awarded_eur_total', 'right', SIZE_TIER_LABELS_PLAIN)} AS size_segment,
  count(notice_id) AS n_notices, median(tenders_count_avg) AS median_bidders, avg(tenders_count_avg) AS mean_bidders,
  avg(CASE WHEN tenders_count_avg <= 1 THEN 1.0 ELSE 0.0 END) * 100 AS pct_solo
FROM notice_awards WHERE awarded_eur_total > 0 AND buyer_country <> '{EX}' AND tenders_count_avg IS NOT NULL GROUP BY 1)
WHERE size_segment IS NOT NULL""")
def competition_by_size(lake):
    """Bidders by notice size tier (ex-country)."""
    d = (K.notice_awards_clean(lake, EX).where(F.col(TC).isNotNull())
         .withColumn("size_segment", C.size_tier("awarded_eur_total", "right", SIZE_TIER_LABELS_PLAIN)))
    g = d.where(F.col("size_segment").isNotNull()).groupBy("size_segment").agg(
        F.count("notice_id").alias("n_notices"), F.median(TC).alias("median_bidders"),
        F.avg(TC).alias("mean_bidders"), (F.avg((F.col(TC) <= 1).cast("double")) * 100).alias("pct_solo"))
    return g.orderBy(K.tier_order("size_segment", SIZE_TIER_LABELS_PLAIN))


@query("market_tier", sql=f"""
WITH c AS (SELECT buyer_country, median(tenders_count_avg) AS median_bidders, count(notice_id) AS n_notices
           FROM notice_awards WHERE tenders_count_avg IS NOT NULL GROUP BY 1 HAVING count(notice_id) >= 20),
t AS (SELECT *, {K.interval_sql('median_bidders', MARKET_TIERS)} AS market_type FROM c)
SELECT *, count(*) OVER (PARTITION BY market_type) AS n_in_tier FROM t""")
def market_tier(lake):
    """Country market tier on median bidders: (0,2] low, (2,4] medium, >4 high; tier sizes."""
    c = (_with_bidders(lake).groupBy("buyer_country")
         .agg(F.median(TC).alias("median_bidders"), F.count("notice_id").alias("n_notices"))
         .where(F.col("n_notices") >= 20)
         .withColumn("market_type", C.interval_label("median_bidders", MARKET_TIERS)))
    return c.withColumn("n_in_tier", F.count(F.lit(1)).over(W.partitionBy("market_type")))


def _spot_stats(df: DataFrame, keys) -> DataFrame:
    tc = F.col(TC)
    return df.groupBy(*keys).agg(
        F.count("notice_id").alias("n_notices"), F.count(tc).alias("n_with_bidders"),
        F.median(tc).alias("median_bidders"), F.avg(tc).alias("mean_bidders"),
        (F.avg(F.when(tc.isNotNull(), (tc <= 1).cast("double"))) * 100).alias("pct_solo"),
        (F.avg(F.when(tc.isNotNull(), (tc >= 5).cast("double"))) * 100).alias("pct_5plus"))


def _spot_sql(where: str, label: str, section: str, group: str | None = None) -> str:
    lab = group or f"'{label}'"
    grp = f" GROUP BY {group}" if group else ""
    return (f"SELECT '{section}' AS section, {lab} AS label, count(notice_id) AS n_notices, "
            f"count(tenders_count_avg) AS n_with_bidders, median(tenders_count_avg) AS median_bidders, "
            f"avg(tenders_count_avg) AS mean_bidders, "
            f"avg(CASE WHEN tenders_count_avg <= 1 THEN 1.0 WHEN tenders_count_avg IS NOT NULL THEN 0.0 END) * 100 "
            f"AS pct_solo, avg(CASE WHEN tenders_count_avg >= 5 THEN 1.0 WHEN tenders_count_avg IS NOT NULL THEN 0.0 END)"
            f" * 100 AS pct_5plus FROM notice_awards WHERE {where}{grp}")


@query("cpv_spotlight", sql="\nUNION ALL\n".join(
    [_spot_sql(f"cpv_division = '{d}'", d, "division") for d in SPOTLIGHT_DIVISIONS]
    + [_spot_sql("TRUE", "overall", "division"),
       "SELECT * FROM (" + _spot_sql(f"cpv_division = '{SPOTLIGHT_FOCUS}' AND tenders_count_avg IS NOT NULL", "",
                                     "by_country", "buyer_country") + ") WHERE n_notices >= 10",
       "SELECT * FROM (" + _spot_sql(
           f"cpv_division = '{SPOTLIGHT_FOCUS}' AND tenders_count_avg IS NOT NULL AND awarded_eur_total > 0 "
           f"AND buyer_country <> '{EX}'", "", "by_size",
           K.tier_sql('awarded_eur_total', 'right', SIZE_TIER_LABELS_PLAIN)) + ") WHERE label IS NOT NULL"]))
def cpv_spotlight(lake):
    """Category spotlight: chosen divisions vs overall; focus division by country (>= 10) and by size."""
    na = K.notice_awards(lake)
    parts = [_spot_stats(na.where(F.col("cpv_division") == d), []).select(
        F.lit("division").alias("section"), F.lit(d).alias("label"), "*") for d in SPOTLIGHT_DIVISIONS]
    parts.append(_spot_stats(na, []).select(F.lit("division").alias("section"), F.lit("overall").alias("label"), "*"))
    focus = na.where((F.col("cpv_division") == SPOTLIGHT_FOCUS) & F.col(TC).isNotNull())
    parts.append(_spot_stats(focus, [F.col("buyer_country").alias("label")]).where(F.col("n_notices") >= 10)
                 .select(F.lit("by_country").alias("section"), "*"))
    sized = (focus.where((F.col("awarded_eur_total") > 0) & (F.col("buyer_country") != EX))
             .withColumn("label", C.size_tier("awarded_eur_total", "right", SIZE_TIER_LABELS_PLAIN))
             .where(F.col("label").isNotNull()))
    parts.append(_spot_stats(sized, ["label"]).select(F.lit("by_size").alias("section"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)
