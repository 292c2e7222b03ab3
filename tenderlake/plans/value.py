"""Value and financial study (O-VAL-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.gold import first_non_null, zero_sum
from ..registry import query
from . import common as K

CV = K.CV_CLEAN_SQL
EX = K.EX
VALUE_COLS = ["contract_value", "total_awarded", "awarded_amount", "lot_est", "estimated"]
# FIXED VALUES: spend brackets on notice totals, left-closed [lo, hi).
VALUE_BRACKETS = (
    ("< €10K", 0.0, 10_000.0),
    ("€10K–€100K", 10_000.0, 100_000.0),
    ("€100K–€1M", 100_000.0, 1_000_000.0),
    ("€1M–€10M", 1_000_000.0, 10_000_000.0),
    ("€10M–€100M", 10_000_000.0, 100_000_000.0),
    ("> €100M", 100_000_000.0, float("inf")),
)
# FIXED VALUES: the CPV divisions singled out by the study.
SELECTED_DIVISIONS = ("72", "48", "73", "79", "50")
CONCENTRATION_PCTS = (1, 5, 10, 20, 50)
BUYER_NS = (1, 5, 10, 25, 50, 100)


def _scoped(lake) -> DataFrame:
    """notice_awards_clean tagged 'all', plus the ex-country copy tagged 'ex_HUN'."""
    c = K.notice_awards_clean(lake)
    return (c.withColumn("scope", F.lit("all"))
            .unionByName(c.where(F.col("buyer_country") != EX).withColumn("scope", F.lit("ex_" + EX))))


SCOPED_SQL = f"""scoped AS (SELECT *, 'all' AS scope FROM notice_awards WHERE awarded_eur_total > 0
  UNION ALL SELECT *, 'ex_{EX}' FROM notice_awards WHERE awarded_eur_total > 0 AND buyer_country <> '{EX}')"""


def _buyer_names(lake) -> DataFrame:
    """One (buyer_name, buyer_country) per notice from the award rows."""
    return (K.award_values(lake).groupBy("notice_id")
            .agg(first_non_null("buyer_name", "lot_result_id").alias("buyer_name")))


@query("notice_awards", sql="SELECT *, awarded_eur_total > 0 AS is_clean FROM notice_awards")
def notice_awards(lake):
    """Lot awards collapsed to notice grain (value capped), with a positive-value flag."""
    return K.notice_awards(lake).withColumn("is_clean", F.col("awarded_eur_total") > 0)


@query("value_coverage", sql="WITH t AS (SELECT count(*) AS n, " + ", ".join(
    f"count({c}) AS v_{c}, max({c}) AS m_{c}" for c in VALUE_COLS) + """,
  count(DISTINCT notice_id) FILTER (WHERE contract_value > 0) AS nwv, count(DISTINCT notice_id) AS nt
  FROM gold_awards)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, v_{c} AS n_valid, n - v_{c} AS n_null, v_{c} * 100.0 / n AS pct_valid, "
    f"m_{c} AS max_value, nwv AS notices_with_value, nt AS notices_total FROM t" for c in VALUE_COLS))
def value_coverage(lake):
    """Valid / null / % / max of each value column; notices with a positive value."""
    aw = lake.gold("gold_awards")
    agg = aw.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count(c).alias(f"v_{c}") for c in VALUE_COLS], *[F.max(c).alias(f"m_{c}") for c in VALUE_COLS],
                 F.count_distinct(F.when(F.col("contract_value") > 0, F.col("notice_id"))).alias("nwv"),
                 F.count_distinct("notice_id").alias("nt"))
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"v_{c}").alias("n_valid"),
                                        F.col(f"m_{c}").cast("double").alias("max_value")) for c in VALUE_COLS]))
    return agg.select(rows.alias("r"), "n", "nwv", "nt").select(
        "r.column_name", "r.n_valid", (F.col("n") - F.col("r.n_valid")).alias("n_null"),
        (F.col("r.n_valid") * 100.0 / F.col("n")).alias("pct_valid"), "r.max_value",
        F.col("nwv").alias("notices_with_value"), F.col("nt").alias("notices_total"))


def _coverage(df, dim, value_col, min_n, total_name, has_name):
    g = (df.where(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value"))
         .agg(F.count(F.lit(1)).alias(total_name), F.count(value_col).alias(has_name)))
    g = g.where(F.col(total_name) >= min_n) if min_n else g
    return g.select(F.lit(dim).alias("dimension"), "value", total_name, has_name,
                    (F.col(has_name) * 100.0 / F.col(total_name)).alias("pct_coverage"))


@query("estimate_coverage", sql="""
SELECT 'buyer_country' AS dimension, buyer_country AS value, count(*) AS total_notices, count(estimated) AS has_estimated,
  count(estimated) * 100.0 / count(*) AS pct_coverage FROM gold_notices WHERE buyer_country IS NOT NULL
GROUP BY buyer_country HAVING count(*) >= 100
UNION ALL
SELECT 'proc_type', proc_type, count(*), count(estimated), count(estimated) * 100.0 / count(*) FROM gold_notices
WHERE proc_type IS NOT NULL GROUP BY proc_type""")
def estimate_coverage(lake):
    """Share of notices with an estimate: by country (>= 100 notices) and by type."""
    g = lake.gold("gold_notices", "notice_id", "buyer_country", "proc_type", "estimated")
    return (_coverage(g, "buyer_country", "estimated", 100, "total_notices", "has_estimated")
            .unionByName(_coverage(g, "proc_type", "estimated", 0, "total_notices", "has_estimated")))


@query("award_coverage", sql=f"""
SELECT 'proc_type' AS dimension, proc_type AS value, count(*) AS total_lots, count(contract_value) AS lots_with_val,
  count(contract_value) * 100.0 / count(*) AS pct_coverage, COALESCE(sum({CV}), 0) AS total_eur
FROM gold_awards WHERE proc_type IS NOT NULL GROUP BY proc_type
UNION ALL
SELECT 'buyer_country', buyer_country, count(*), count(contract_value), count(contract_value) * 100.0 / count(*),
  COALESCE(sum({CV}), 0) FROM gold_awards WHERE buyer_country IS NOT NULL GROUP BY buyer_country HAVING count(*) >= 50""")
def award_coverage(lake):
    """Share of award lots with a contract value: by type and by country (>= 50 lots)."""
    aw = lake.gold("gold_awards").withColumn("cv_clean", K.cap_value("contract_value"))
    out = []
    for dim, min_n in (("proc_type", 0), ("buyer_country", 50)):
        g = (aw.where(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value"))
             .agg(F.count(F.lit(1)).alias("total_lots"), F.count("contract_value").alias("lots_with_val"),
                  zero_sum("cv_clean").alias("total_eur")))
        g = g.where(F.col("total_lots") >= min_n) if min_n else g
        out.append(g.select(F.lit(dim).alias("dimension"), "value", "total_lots", "lots_with_val",
                            (F.col("lots_with_val") * 100.0 / F.col("total_lots")).alias("pct_coverage"),
                            "total_eur"))
    return out[0].unionByName(out[1])


def _pareto(df: DataFrame, keys: list[str], total_col: str, count_col: str, part=("scope",)) -> DataFrame:
    """Share, running share and the '80 % reached' set over an aggregated frame.

    The running window is partitioned by scope and runs over one row per
    group (countries / CPV divisions), a bounded dimension.
    """
    w_all = W.partitionBy(*part)
    w_run = W.partitionBy(*part).orderBy(F.col(total_col).desc(), *keys).rowsBetween(W.unboundedPreceding, 0)
    out = df.withColumns({
        "pct_of_total": F.col(total_col) * 100.0 / F.sum(total_col).over(w_all),
        "rank": F.row_number().over(W.partitionBy(*part).orderBy(F.col(total_col).desc(), *keys)).cast("bigint"),
    }).withColumn("cumulative_pct", F.sum("pct_of_total").over(w_run))
    n80 = F.count_if(F.col("cumulative_pct") <= 80).over(w_all) + 1
    return out.withColumn("in_top_80", F.col("rank") <= n80)


def _pareto_sql(keys: str, order: str, total: str, part: str = "scope") -> str:
    return f"""SELECT *, rank <= count(*) FILTER (WHERE cumulative_pct <= 80) OVER (PARTITION BY {part}) + 1 AS in_top_80
FROM (SELECT *, sum(pct_of_total) OVER (PARTITION BY {part} ORDER BY {total} DESC, {order}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_pct
      FROM (SELECT *, {total} * 100.0 / sum({total}) OVER (PARTITION BY {part}) AS pct_of_total,
              row_number() OVER (PARTITION BY {part} ORDER BY {total} DESC, {order}) AS rank FROM {keys}))"""


@query("spend_pareto_country", sql=f"""WITH {SCOPED_SQL},
g AS (SELECT scope, buyer_country, sum(awarded_eur_total) AS total_awarded_eur, count(notice_id) AS notice_count
      FROM scoped GROUP BY 1, 2)
{_pareto_sql('g', 'buyer_country', 'total_awarded_eur')}""")
def spend_pareto_country(lake):
    """Spend by country, share, running share, countries needed for 80 % (full and ex-country)."""
    g = _scoped(lake).groupBy("scope", "buyer_country").agg(
        F.sum("awarded_eur_total").alias("total_awarded_eur"), F.count("notice_id").alias("notice_count"))
    return _pareto(g, ["buyer_country"], "total_awarded_eur", "notice_count")


@query("round_number_flags", sql=f"""
SELECT buyer_country, count(*) AS n_lots, count(*) FILTER (WHERE {CV} >= 1e9) AS n_big_lots,
  COALESCE(sum(CASE WHEN {CV} >= 1e9 THEN {CV} END), 0) AS total_big_eur,
  count(*) FILTER (WHERE {CV} >= 1e9 AND ({CV}) % 1e9 = 0) AS n_round_billion,
  count(*) FILTER (WHERE {CV} >= 1e9 AND ({CV}) % 5e8 = 0) AS n_round_500m,
  count(*) FILTER (WHERE {CV} >= 1e9 AND contract_count = 0) AS n_zero_contract_count,
  count(*) FILTER (WHERE {CV} >= 1e9 AND contract_count IS NULL) AS n_null_contract_count
FROM gold_awards WHERE buyer_country IS NOT NULL GROUP BY buyer_country""")
def round_number_flags(lake, threshold: float = 1e9):
    """Ceiling diagnostic per country: lots >= 1e9, round multiples, missing contract counts."""
    aw = lake.gold("gold_awards", "notice_id", "lot_result_id", "buyer_country", "contract_value", "contract_count").withColumn(
        "cv", K.cap_value("contract_value"))
    big = F.col("cv") >= threshold
    return (aw.where(F.col("buyer_country").isNotNull()).groupBy("buyer_country").agg(
        F.count(F.lit(1)).alias("n_lots"), F.count_if(big).alias("n_big_lots"),
        zero_sum(F.when(big, F.col("cv"))).alias("total_big_eur"),
        F.count_if(big & (F.pmod("cv", F.lit(1e9)) == 0)).alias("n_round_billion"),
        F.count_if(big & (F.pmod("cv", F.lit(5e8)) == 0)).alias("n_round_500m"),
        F.count_if(big & (F.col("contract_count") == 0)).alias("n_zero_contract_count"),
        F.count_if(big & F.col("contract_count").isNull()).alias("n_null_contract_count")))


@query("contract_size_country", sql=f"""WITH {SCOPED_SQL}
SELECT scope, buyer_country, avg(awarded_eur_total) AS mean_eur, median(awarded_eur_total) AS median_eur,
  stddev_samp(awarded_eur_total) AS std_eur, count(notice_id) AS n_notices, max(awarded_eur_total) AS max_eur,
  avg(awarded_eur_total) > 5 * median(awarded_eur_total) AS high_skew
FROM scoped GROUP BY 1, 2 HAVING count(notice_id) >= 20""")
def contract_size_country(lake):
    """Notice contract size by country (n >= 20): mean, median, std, max, skew flag."""
    s = _scoped(lake)
    g = s.groupBy("scope", "buyer_country").agg(
        F.avg("awarded_eur_total").alias("mean_eur"),
        F.stddev_samp("awarded_eur_total").alias("std_eur"), F.count("notice_id").alias("n_notices"),
        F.max("awarded_eur_total").alias("max_eur"))
    g = g.join(K.grouped_median(lake.spark, s, ["scope", "buyer_country"], "awarded_eur_total", "median_eur"),
               ["scope", "buyer_country"], "left")
    return (g.where(F.col("n_notices") >= 20)
            .withColumn("high_skew", F.col("mean_eur") > 5 * F.col("median_eur")))


@query("contract_size_overall", sql=f"""WITH {SCOPED_SQL}
SELECT scope, median(awarded_eur_total) AS median_eur, avg(awarded_eur_total) AS mean_eur, count(*) AS n_notices
FROM scoped GROUP BY scope""")
def contract_size_overall(lake):
    """Overall notice contract size (full and ex-country)."""
    s = _scoped(lake)
    return (s.groupBy("scope").agg(F.avg("awarded_eur_total").alias("mean_eur"), F.count(F.lit(1)).alias("n_notices"))
            .join(K.grouped_median(lake.spark, s, ["scope"], "awarded_eur_total", "median_eur"), "scope", "left"))


def savings_lots(lake, trim: float = 200.0) -> DataFrame:
    """Estimate vs award per notice from lots with both values (estimate summed
    per lot, as the value study does), trimmed to +-``trim`` %."""
    aw = lake.gold("gold_awards", "notice_id", "lot_result_id", "buyer_country", "proc_type", "estimated", "contract_value").withColumn(
        "cv_clean", K.cap_value("contract_value"))
    lots = aw.where(F.col("estimated").isNotNull() & F.col("cv_clean").isNotNull() & (F.col("cv_clean") > 0)
                    & F.col("buyer_country").isNotNull() & F.col("proc_type").isNotNull())
    g = (lots.groupBy("notice_id", "buyer_country", "proc_type")
         .agg(F.sum("estimated").alias("estimated_total"), F.sum("cv_clean").alias("awarded_total"))
         .where((F.col("estimated_total") > 0) & (F.col("awarded_total") > 0)))
    g = g.withColumn("savings_eur", F.col("estimated_total") - F.col("awarded_total"))
    g = g.withColumn("savings_pct", F.col("savings_eur") / F.col("estimated_total") * 100)
    return g.where((F.col("savings_pct") >= -trim) & (F.col("savings_pct") <= trim))


SAVINGS_SQL = f"""sv AS (
SELECT * FROM (
  SELECT *, estimated_total - awarded_total AS savings_eur,
    (estimated_total - awarded_total) / estimated_total * 100 AS savings_pct
  FROM (SELECT notice_id, buyer_country, proc_type, sum(estimated) AS estimated_total, sum({CV}) AS awarded_total
        FROM gold_awards
        WHERE estimated IS NOT NULL AND contract_value IS NOT NULL AND {CV} > 0
          AND buyer_country IS NOT NULL AND proc_type IS NOT NULL
        GROUP BY 1, 2, 3)
  WHERE estimated_total > 0 AND awarded_total > 0)
WHERE savings_pct BETWEEN -200 AND 200)"""


@query("savings_notice", sql=f"WITH {SAVINGS_SQL} SELECT * FROM sv")
def savings_notice(lake):
    """Per-notice savings (estimate vs capped award), trimmed at +-200 %."""
    return savings_lots(lake)


@query("savings_summary", sql=f"""WITH {SAVINGS_SQL}
SELECT count(*) AS n_contracts, median(savings_pct) AS median_savings_pct, avg(savings_pct) AS mean_savings_pct,
  count(*) FILTER (WHERE savings_pct < 0) AS n_over, count(*) FILTER (WHERE savings_pct > 0) AS n_under,
  count(*) FILTER (WHERE savings_pct < 0) * 100.0 / count(*) AS pct_over,
  count(*) FILTER (WHERE savings_pct > 0) * 100.0 / count(*) AS pct_under FROM sv""")
def savings_summary(lake):
    """Savings distribution: n, median, mean, share over / under budget."""
    s = savings_lots(lake)
    med = K.grouped_median(lake.spark, s, [], "savings_pct", "m").select("m").scalar()
    return s.agg(F.count(F.lit(1)).alias("n_contracts"), med.alias("median_savings_pct"),
                 F.avg("savings_pct").alias("mean_savings_pct"),
                 F.count_if(F.col("savings_pct") < 0).alias("n_over"),
                 F.count_if(F.col("savings_pct") > 0).alias("n_under"),
                 (F.count_if(F.col("savings_pct") < 0) * 100.0 / F.count(F.lit(1))).alias("pct_over"),
                 (F.count_if(F.col("savings_pct") > 0) * 100.0 / F.count(F.lit(1))).alias("pct_under"))


@query("savings_by_country", sql=f"""WITH {SAVINGS_SQL}
SELECT buyer_country, avg(savings_pct) AS mean_savings_pct, median(savings_pct) AS median_savings_pct,
  count(notice_id) AS n_contracts, sum(savings_eur) AS total_savings_eur, median(savings_pct) < 0 AS overrun
FROM sv GROUP BY buyer_country HAVING count(notice_id) >= 5""")
def savings_by_country(lake):
    """Savings by country (>= 5 notices) with an overrun flag."""
    sl = savings_lots(lake)
    g = sl.groupBy("buyer_country").agg(
        F.avg("savings_pct").alias("mean_savings_pct"),
        F.count("notice_id").alias("n_contracts"), F.sum("savings_eur").alias("total_savings_eur"))
    g = g.join(K.grouped_median(lake.spark, sl, ["buyer_country"], "savings_pct", "median_savings_pct"),
               "buyer_country", "left")
    return (g.where(F.col("n_contracts") >= 5).withColumn("overrun", F.col("median_savings_pct") < 0)
            .orderBy(F.col("median_savings_pct").desc(), "buyer_country"))


@query("savings_by_type", sql=f"""WITH {SAVINGS_SQL}
SELECT proc_type, avg(savings_pct) AS mean_savings_pct, median(savings_pct) AS median_savings_pct,
  count(*) AS n_contracts FROM sv GROUP BY proc_type HAVING count(*) >= 5""")
def savings_by_type(lake):
    """Savings by procurement type (>= 5 notices)."""
    sl = savings_lots(lake)
    g = sl.groupBy("proc_type").agg(F.avg("savings_pct").alias("mean_savings_pct"),
                                    F.count(F.lit(1)).alias("n_contracts"))
    g = g.join(K.grouped_median(lake.spark, sl, ["proc_type"], "savings_pct", "median_savings_pct"), "proc_type",
               "left")
    return g.where(F.col("n_contracts") >= 5)


def _ranked_clean(lake) -> DataFrame:
    c = K.notice_awards_clean(lake).select("notice_id", "awarded_eur_total")
    return K.global_rank(lake.spark, c, [F.col("awarded_eur_total").desc(), F.col("notice_id")],
                         value="awarded_eur_total")


@query("top_pct_concentration", sql="""
WITH r AS (SELECT awarded_eur_total AS v, row_number() OVER (ORDER BY awarded_eur_total DESC, notice_id) AS rank,
             count(*) OVER () AS n FROM notice_awards WHERE awarded_eur_total > 0),
p AS (SELECT * FROM (VALUES (1), (5), (10), (20), (50)) t(pct_threshold))
SELECT pct_threshold, greatest(1, (max(n) * pct_threshold) // 100) AS n_contracts,
  sum(v) FILTER (WHERE rank <= greatest(1, (n * pct_threshold) // 100)) AS top_value,
  sum(v) FILTER (WHERE rank <= greatest(1, (n * pct_threshold) // 100)) * 100.0 / sum(v) AS top_share_pct
FROM r, p GROUP BY pct_threshold""")
def top_pct_concentration(lake):
    """Share of spend held by the top 1/5/10/20/50 % of notices (n = max(1, floor(N*p)))."""
    r = _ranked_clean(lake)
    n = K.total(r)
    cols = []
    for p in CONCENTRATION_PCTS:
        k = F.greatest(F.lit(1), F.floor(n * p / 100))
        cols.append(F.struct(F.lit(p).alias("pct_threshold"), k.cast("bigint").alias("n_contracts"),
                             F.sum(F.when(F.col("rank") <= k, F.col("awarded_eur_total"))).alias("top_value")))
    agg = r.agg(F.array(*cols).alias("a"), F.sum("awarded_eur_total").alias("_t"))
    return agg.select(F.explode("a").alias("x"), "_t").select(
        "x.pct_threshold", "x.n_contracts", "x.top_value", (F.col("x.top_value") * 100.0 / F.col("_t"))
        .alias("top_share_pct"))


@query("value_brackets", sql="WITH c AS (SELECT awarded_eur_total AS v FROM notice_awards WHERE awarded_eur_total > 0),\n"
       "b AS (" + " UNION ALL ".join(
           f"SELECT {i} AS bracket_order, '{label}' AS bracket, count(v) AS n_notices, COALESCE(sum(v), 0) AS total_eur "
           f"FROM c WHERE v >= {lo}" + (f" AND v < {hi}" if hi != float('inf') else "")
           for i, (label, lo, hi) in enumerate(VALUE_BRACKETS, 1)) + ")\n"
       "SELECT *, n_notices * 100.0 / (SELECT count(*) FROM c) AS pct_notices, "
       "total_eur * 100.0 / (SELECT sum(v) FROM c) AS pct_value FROM b")
def value_brackets(lake):
    """Six left-closed value brackets: notices and value, with shares."""
    c = K.notice_awards_clean(lake).select(F.col("awarded_eur_total").alias("v"))
    bracket = F.lit(None).cast("int")
    for i, (_, lo, hi) in reversed(list(enumerate(VALUE_BRACKETS, 1))):
        bracket = F.when((F.col("v") >= lo) & (F.col("v") < hi), i).otherwise(bracket)
    g = c.groupBy(bracket.alias("bracket_order")).agg(F.count(F.lit(1)).alias("n_notices"),
                                                      F.sum("v").alias("total_eur"))
    dims = lake.spark.createDataFrame([(i, label) for i, (label, _, _) in enumerate(VALUE_BRACKETS, 1)],
                                      "bracket_order int, bracket string")
    out = dims.join(g, "bracket_order", "left").select(
        "bracket_order", "bracket", F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("total_eur", F.lit(0.0)).alias("total_eur"))
    return out.select("*", K.pct(F.col("n_notices"), K.total(c)).alias("pct_notices"),
                      K.pct(F.col("total_eur"), K.total(c, F.sum("v"))).alias("pct_value"))


@query("cumulative_curve", sql="""
SELECT notice_id, awarded_eur_total, rank,
  CASE WHEN n > 1 THEN (rank - 1) * 100.0 / (n - 1) END AS x_pct, running * 100.0 / total AS cum_pct
FROM (SELECT notice_id, awarded_eur_total, row_number() OVER (ORDER BY awarded_eur_total DESC, notice_id) AS rank,
        sum(awarded_eur_total) OVER (ORDER BY awarded_eur_total DESC, notice_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
        count(*) OVER () AS n, sum(awarded_eur_total) OVER () AS total
      FROM notice_awards WHERE awarded_eur_total > 0)""")
def cumulative_curve(lake):
    """Lorenz-type curve: % of notices (largest first) vs cumulative % of spend."""
    r = _ranked_clean(lake)
    n, tot = K.total(r), K.total(r, F.sum("awarded_eur_total"))
    return r.select("notice_id", "awarded_eur_total", "rank",
                    F.when(n > 1, (F.col("rank") - 1) * 100.0 / (n - 1)).alias("x_pct"),
                    (F.col("running") * 100.0 / tot).alias("cum_pct"))


@query("spend_by_type", sql="""
WITH s AS (SELECT proc_type, sum(awarded_eur_total) AS total_eur, avg(awarded_eur_total) AS mean_eur,
             median(awarded_eur_total) AS median_eur, count(notice_id) AS n_contracts
           FROM notice_awards WHERE awarded_eur_total > 0 GROUP BY proc_type),
c AS (SELECT proc_type, count(*) AS cn_count FROM gold_opportunities WHERE proc_type IS NOT NULL GROUP BY 1)
SELECT s.*, total_eur * 100.0 / sum(total_eur) OVER () AS pct_of_spend, c.cn_count,
  total_eur / c.cn_count AS eur_per_cn_notice
FROM s LEFT JOIN c ON c.proc_type = s.proc_type""")
def spend_by_type(lake):
    """Spend by type with share, joined to open-notice counts (EUR per open notice)."""
    c = K.notice_awards_clean(lake)
    s = (c.groupBy("proc_type").agg(F.sum("awarded_eur_total").alias("total_eur"),
                                    F.avg("awarded_eur_total").alias("mean_eur"),
                                    F.count("notice_id").alias("n_contracts"))
         .join(K.grouped_median(lake.spark, c, ["proc_type"], "awarded_eur_total", "median_eur"), "proc_type", "left"))
    cn = K.value_counts(lake.gold("gold_opportunities"), "proc_type", "cn_count")
    return (s.join(cn, "proc_type", "left")
            .withColumns({"pct_of_spend": K.pct(F.col("total_eur"), K.total(c, F.sum("awarded_eur_total"))),
                          "eur_per_cn_notice": F.try_divide(F.col("total_eur"), F.col("cn_count"))}))


@query("spend_by_cpv", sql=f"""
WITH g AS (SELECT 'all' AS scope, cpv_division, cpv_division_name, sum(awarded_eur_total) AS total_eur,
             avg(awarded_eur_total) AS mean_eur, median(awarded_eur_total) AS median_eur,
             count(notice_id) AS n_contracts FROM notice_awards WHERE awarded_eur_total > 0 GROUP BY 1, 2, 3)
SELECT *, cpv_division IN ({", ".join(f"'{d}'" for d in SELECTED_DIVISIONS)}) AS is_selected FROM (
{_pareto_sql('g', 'cpv_division, cpv_division_name', 'total_eur')})""")
def spend_by_cpv(lake):
    """Spend by CPV division: sum, mean, median, n, share, running share, 80 % set."""
    c = K.notice_awards_clean(lake).withColumn("scope", F.lit("all"))
    keys = ["scope", "cpv_division", "cpv_division_name"]
    g = (c.groupBy(*keys)
         .agg(F.sum("awarded_eur_total").alias("total_eur"), F.avg("awarded_eur_total").alias("mean_eur"),
              F.count("notice_id").alias("n_contracts"))
         .join(K.grouped_median(lake.spark, c, keys, "awarded_eur_total", "median_eur"), keys, "left"))
    return (_pareto(g, ["cpv_division", "cpv_division_name"], "total_eur", "n_contracts")
            .withColumn("is_selected", F.col("cpv_division").isin(*SELECTED_DIVISIONS)))


@query("top_contracts", sql=f"""WITH {SCOPED_SQL},
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY awarded_eur_total DESC, notice_id)
        AS rank FROM scoped) WHERE rank <= 25),
ti AS (SELECT notice_id, arg_min(project_title, lot_result_id) FILTER (WHERE project_title IS NOT NULL)
         AS project_title, arg_min(buyer_name, lot_result_id) FILTER (WHERE buyer_name IS NOT NULL) AS buyer_name
       FROM gold_awards GROUP BY notice_id)
SELECT t.scope, t.rank, t.notice_id, t.awarded_eur_total, t.buyer_country, t.proc_type, t.cpv_division,
  ti.project_title, ti.buyer_name
FROM t LEFT JOIN ti ON ti.notice_id = t.notice_id""")
def top_contracts(lake):
    """Largest 25 notices (full and ex-country) with first title and buyer."""
    s = _scoped(lake)
    tops = reduce(lambda a, b: a.unionByName(b), [
        K.top_k(s.where(F.col("scope") == sc), 25, F.col("awarded_eur_total").desc(), F.col("notice_id"))
        for sc in ("all", "ex_" + EX)])
    ids = tops.select("notice_id").distinct()
    titles = (lake.gold("gold_awards").join(ids, "notice_id", "left_semi").groupBy("notice_id")
              .agg(first_non_null("project_title", "lot_result_id").alias("project_title"),
                   first_non_null("buyer_name", "lot_result_id").alias("buyer_name")))
    return tops.join(titles, "notice_id", "left").select(
        "scope", "rank", "notice_id", "awarded_eur_total", "buyer_country", "proc_type", "cpv_division",
        "project_title", "buyer_name")


def _buyer_spend(lake) -> DataFrame:
    return (_scoped(lake).join(_buyer_names(lake), "notice_id", "left").where(F.col("buyer_name").isNotNull())
            .groupBy("scope", "buyer_name", "buyer_country")
            .agg(F.sum("awarded_eur_total").alias("total_eur"), F.count("notice_id").alias("n_contracts")))


BUYER_SQL = f"""{SCOPED_SQL},
bn AS (SELECT notice_id, arg_min(buyer_name, lot_result_id) FILTER (WHERE buyer_name IS NOT NULL) AS buyer_name
       FROM gold_awards GROUP BY notice_id),
bs AS (SELECT scope, bn.buyer_name, buyer_country, sum(awarded_eur_total) AS total_eur,
         count(scoped.notice_id) AS n_contracts
       FROM scoped LEFT JOIN bn ON bn.notice_id = scoped.notice_id WHERE bn.buyer_name IS NOT NULL GROUP BY 1, 2, 3)"""


@query("buyer_leaderboard", sql=f"""WITH {BUYER_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY total_eur DESC, buyer_name, buyer_country) AS rank,
        sum(total_eur) OVER (PARTITION BY scope) AS scope_total, count(*) OVER (PARTITION BY scope) AS n_buyers
      FROM bs)
SELECT scope, rank, buyer_name, buyer_country, total_eur, n_contracts, total_eur * 100.0 / scope_total AS share_pct,
  sum(total_eur) FILTER (WHERE rank <= 10) OVER (PARTITION BY scope) * 100.0 / scope_total AS top10_share_pct, n_buyers
FROM r WHERE rank <= 20""")
def buyer_leaderboard(lake):
    """Top 20 buyers by spend (full and ex-country), shares, top-10 share, buyer count."""
    bs = _buyer_spend(lake)
    stats = bs.groupBy("scope").agg(F.sum("total_eur").alias("scope_total"), F.count(F.lit(1)).alias("n_buyers"))
    order = [F.col("total_eur").desc(), F.col("buyer_name"), F.col("buyer_country")]
    tops = reduce(lambda a, b: a.unionByName(b), [
        K.top_k(bs.where(F.col("scope") == sc), 20, *order) for sc in ("all", "ex_" + EX)])
    top10 = tops.where(F.col("rank") <= 10).groupBy("scope").agg(F.sum("total_eur").alias("_t10"))
    return (tops.join(F.broadcast(stats), "scope").join(F.broadcast(top10), "scope")
            .select("scope", "rank", "buyer_name", "buyer_country", "total_eur", "n_contracts",
                    (F.col("total_eur") * 100.0 / F.col("scope_total")).alias("share_pct"),
                    (F.col("_t10") * 100.0 / F.col("scope_total")).alias("top10_share_pct"), "n_buyers"))


@query("buyer_concentration", sql=f"""WITH {BUYER_SQL},
r AS (SELECT scope, row_number() OVER (PARTITION BY scope ORDER BY total_eur DESC, buyer_name, buyer_country) AS n,
        sum(total_eur) OVER (PARTITION BY scope ORDER BY total_eur DESC, buyer_name, buyer_country
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / sum(total_eur) OVER (PARTITION BY scope)
          AS cumulative_pct,
        count(*) OVER (PARTITION BY scope) AS n_buyers FROM bs)
SELECT scope, n, cumulative_pct, n * 100.0 / n_buyers AS pct_buyers FROM r
WHERE n IN ({", ".join(str(x) for x in BUYER_NS)})""")
def buyer_concentration(lake):
    """Cumulative spend share of the top 1/5/10/25/50/100 buyers."""
    bs = _buyer_spend(lake)
    stats = bs.groupBy("scope").agg(F.sum("total_eur").alias("scope_total"), F.count(F.lit(1)).alias("n_buyers"))
    order = [F.col("total_eur").desc(), F.col("buyer_name"), F.col("buyer_country")]
    kmax = max(BUYER_NS)
    tops = reduce(lambda a, b: a.unionByName(b), [
        K.top_k(bs.where(F.col("scope") == sc), kmax, *order, rank_col="n") for sc in ("all", "ex_" + EX)])
    w = W.partitionBy("scope").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    return (tops.withColumn("_run", F.sum("total_eur").over(w)).join(F.broadcast(stats), "scope")
            .where(F.col("n").isin(*BUYER_NS))
            .select("scope", "n", (F.col("_run") * 100.0 / F.col("scope_total")).alias("cumulative_pct"),
                    (F.col("n") * 100.0 / F.col("n_buyers")).alias("pct_buyers")))


@query("size_tiers", sql=f"""
WITH a AS (SELECT {K.tier_sql(CV)} AS size_segment, {CV} AS cv FROM gold_awards WHERE contract_value IS NOT NULL),
g AS (SELECT size_segment, count(*) AS lot_count, sum(cv) AS total_spend, avg(cv) AS avg_value,
        median(cv) AS median_value FROM a WHERE size_segment IS NOT NULL GROUP BY 1)
SELECT *, lot_count * 100.0 / sum(lot_count) OVER () AS pct_lots, total_spend * 100.0 / sum(total_spend) OVER ()
  AS pct_spend FROM g""")
def size_tiers(lake):
    """Lot-grain size tiers (right-closed): count, spend, mean, median, % lots, % spend."""
    a = (lake.gold("gold_awards").where(F.col("contract_value").isNotNull())
         .select(K.cap_value("contract_value").alias("cv"))
         .withColumn("size_segment", K.C.size_tier("cv", "right")).where(F.col("size_segment").isNotNull()))
    g = (a.groupBy("size_segment").agg(F.count(F.lit(1)).alias("lot_count"), F.sum("cv").alias("total_spend"),
                                       F.avg("cv").alias("avg_value"))
         .join(K.grouped_median(lake.spark, a, ["size_segment"], "cv", "median_value"), "size_segment", "left"))
    return (g.select("*", K.pct(F.col("lot_count"), K.total(a)).alias("pct_lots"),
                     K.pct(F.col("total_spend"), K.total(a, F.sum("cv"))).alias("pct_spend"))
            .orderBy(K.tier_order("size_segment")))


@query("size_tiers_by_type", sql=f"""
WITH a AS (SELECT proc_type, {K.tier_sql(CV)} AS size_segment, {CV} AS cv FROM gold_awards
           WHERE contract_value IS NOT NULL AND proc_type IS NOT NULL),
g AS (SELECT proc_type, size_segment, count(*) AS lot_count, sum(cv) AS total_spend FROM a
      WHERE size_segment IS NOT NULL GROUP BY 1, 2)
SELECT *, lot_count * 100.0 / sum(lot_count) OVER (PARTITION BY proc_type) AS pct_lots,
  total_spend * 100.0 / sum(total_spend) OVER (PARTITION BY proc_type) AS pct_spend FROM g""")
def size_tiers_by_type(lake):
    """Size tiers within each procurement type, with in-type shares."""
    a = (lake.gold("gold_awards").where(F.col("contract_value").isNotNull() & F.col("proc_type").isNotNull())
         .select("proc_type", K.cap_value("contract_value").alias("cv"))
         .withColumn("size_segment", K.C.size_tier("cv", "right")).where(F.col("size_segment").isNotNull()))
    g = a.groupBy("proc_type", "size_segment").agg(F.count(F.lit(1)).alias("lot_count"),
                                                   F.sum("cv").alias("total_spend"))
    w = W.partitionBy("proc_type")
    return g.withColumns({"pct_lots": F.col("lot_count") * 100.0 / F.sum("lot_count").over(w),
                          "pct_spend": F.col("total_spend") * 100.0 / F.sum("total_spend").over(w)})


@query("dominant_buyer", sql=f"""WITH {SCOPED_SQL},
bn AS (SELECT notice_id, arg_min(buyer_name, lot_result_id) FILTER (WHERE buyer_name IS NOT NULL) AS buyer_name
       FROM gold_awards GROUP BY notice_id),
g AS (SELECT scope, buyer_country, bn.buyer_name, sum(awarded_eur_total) AS buyer_total,
        count(scoped.notice_id) AS n_contracts
      FROM scoped LEFT JOIN bn ON bn.notice_id = scoped.notice_id WHERE bn.buyer_name IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT *, sum(buyer_total) OVER (PARTITION BY scope, buyer_country) AS country_total,
        row_number() OVER (PARTITION BY scope, buyer_country ORDER BY buyer_total DESC, buyer_name) AS rn FROM g)
SELECT scope, buyer_country, buyer_name, buyer_total, n_contracts, country_total,
  buyer_total * 100.0 / country_total AS dominance_pct, buyer_total * 100.0 / country_total > 50 AS centralised
FROM r WHERE rn = 1""")
def dominant_buyer(lake):
    """Largest buyer per country and its share of the country's spend (> 50 % flagged)."""
    g = (_scoped(lake).join(_buyer_names(lake), "notice_id", "left").where(F.col("buyer_name").isNotNull())
         .groupBy("scope", "buyer_country", "buyer_name")
         .agg(F.sum("awarded_eur_total").alias("buyer_total"), F.count("notice_id").alias("n_contracts")))
    top = g.groupBy("scope", "buyer_country").agg(
        F.min_by(F.struct("buyer_name", "buyer_total", "n_contracts"),
                 F.struct((-F.col("buyer_total")).alias("t"), F.col("buyer_name"))).alias("b"),
        F.sum("buyer_total").alias("country_total"))
    dom = F.col("b.buyer_total") * 100.0 / F.col("country_total")
    return top.select("scope", "buyer_country", "b.buyer_name", "b.buyer_total", "b.n_contracts", "country_total",
                      dom.alias("dominance_pct"), (dom > 50).alias("centralised"))
