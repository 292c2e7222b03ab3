"""Volume and market-structure study (O-VOL-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..registry import query
from . import common as K

P0, P1 = K.PERIOD_START, K.PERIOD_END
KEY_FIELDS = ["notice_type", "pub_date", "buyer_country", "buyer_name", "proc_type", "cpv_code",
              "cpv_division_name", "estimated"]


@query("dataset_scope", sql="""
SELECT count(*) AS n_rows, count(DISTINCT notice_id) AS n_notices, count(DISTINCT buyer_country) AS n_countries,
  count(DISTINCT buyer_name) AS n_buyers, count(DISTINCT cpv_division) AS n_divisions FROM gold_notices""")
def dataset_scope(lake):
    """Rows, distinct notices, countries, buyers and CPV divisions."""
    return lake.gold("gold_notices").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("notice_id").alias("n_notices"),
        F.count_distinct("buyer_country").alias("n_countries"), F.count_distinct("buyer_name").alias("n_buyers"),
        F.count_distinct("cpv_division").alias("n_divisions"))


@query("null_rates", sql="WITH t AS (SELECT count(*) AS n, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in KEY_FIELDS) + " FROM gold_notices)\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS field, {c} AS null_count, {c} * 100.0 / n AS null_pct FROM t" for c in KEY_FIELDS))
def null_rates(lake):
    """Null count and % of the key notice fields (one pass, then unpivot)."""
    g = lake.gold("gold_notices")
    agg = g.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in KEY_FIELDS])
    long = agg.unpivot("_n", KEY_FIELDS, "field", "null_count")
    return long.select("field", "null_count", (F.col("null_count") * 100.0 / F.col("_n")).alias("null_pct"))


@query("notice_type_split", sql="""
SELECT notice_type, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM gold_notices WHERE notice_type IS NOT NULL)
  AS pct FROM gold_notices WHERE notice_type IS NOT NULL GROUP BY notice_type""")
def notice_type_split(lake):
    """Notice-type counts and share."""
    g = lake.gold("gold_notices").where(F.col("notice_type").isNotNull())
    return (K.value_counts(g, "notice_type").withColumn("pct", K.pct(F.col("n"), K.total(g)))
            .orderBy(F.col("n").desc(), "notice_type"))


@query("pin_top", sql="""
WITH p AS (SELECT * FROM gold_notices WHERE notice_type = 'PIN'),
c AS (SELECT 'buyer_country' AS dimension, buyer_country AS value, count(*) AS n FROM p
      WHERE buyer_country IS NOT NULL GROUP BY 1, 2
      UNION ALL
      SELECT 'cpv_division_name', cpv_division_name, count(*) FROM p WHERE cpv_division_name IS NOT NULL GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS rank FROM c)
WHERE rank <= 10""")
def pin_top(lake):
    """Early-signal (PIN) notices: top 10 countries and CPV divisions."""
    p = lake.gold("gold_notices").where(F.col("notice_type") == "PIN")
    c = K.value_counts(p, "buyer_country").select(F.lit("buyer_country").alias("dimension"),
                                                  F.col("buyer_country").alias("value"), "n")
    d = K.value_counts(p, "cpv_division_name").select(F.lit("cpv_division_name").alias("dimension"),
                                                      F.col("cpv_division_name").alias("value"), "n")
    return K.top_k(c.unionByName(d), 10, F.col("n").desc(), F.col("value"), partition=["dimension"])


@query("volume_by_country", sql="""
SELECT buyer_country, count(*) AS n_all, count(*) FILTER (WHERE notice_type = 'CN') AS n_cn,
  count(*) FILTER (WHERE notice_type = 'CAN') AS n_can
FROM gold_notices WHERE buyer_country IS NOT NULL GROUP BY buyer_country ORDER BY n_all DESC, buyer_country LIMIT 20""")
def volume_by_country(lake):
    """Notices by country (all / CN / CAN), top 20 by all."""
    g = lake.gold("gold_notices").where(F.col("buyer_country").isNotNull())
    agg = g.groupBy("buyer_country").agg(F.count(F.lit(1)).alias("n_all"),
                                         F.count_if(F.col("notice_type") == "CN").alias("n_cn"),
                                         F.count_if(F.col("notice_type") == "CAN").alias("n_can"))
    return agg.orderBy(F.col("n_all").desc(), "buyer_country").limit(20)


@query("lots_per_notice", sql="""
WITH g AS (
  SELECT 'buyer_country' AS dimension, buyer_country AS value, count(notice_id) AS award_rows,
    count(DISTINCT notice_id) AS unique_notices FROM gold_awards WHERE buyer_country IS NOT NULL GROUP BY 1, 2
  UNION ALL
  SELECT 'proc_type', proc_type, count(notice_id), count(DISTINCT notice_id) FROM gold_awards
  WHERE proc_type IS NOT NULL GROUP BY 1, 2)
SELECT *, award_rows * 1.0 / unique_notices AS lots_per_notice, award_rows * 1.0 / unique_notices > 2 AS high_lots
FROM g""")
def lots_per_notice(lake):
    """Award rows per distinct notice, by country and by type; > 2 flagged."""
    aw = lake.gold("gold_awards")
    parts = []
    for dim in ("buyer_country", "proc_type"):
        parts.append(aw.where(F.col(dim).isNotNull()).groupBy(F.col(dim).alias("value"))
                     .agg(F.count("notice_id").alias("award_rows"),
                          F.count_distinct("notice_id").alias("unique_notices"))
                     .select(F.lit(dim).alias("dimension"), "value", "award_rows", "unique_notices"))
    df = parts[0].unionByName(parts[1])
    lpn = F.col("award_rows") / F.col("unique_notices")
    return df.withColumns({"lots_per_notice": lpn, "high_lots": lpn > 2})


@query("proc_type_compare", sql="""
WITH u AS (SELECT proc_type, 'n_all' AS src FROM gold_notices UNION ALL
           SELECT proc_type, 'n_cn' FROM gold_opportunities UNION ALL SELECT proc_type, 'n_can' FROM gold_awards)
SELECT proc_type, count(*) FILTER (WHERE src = 'n_all') AS n_all, count(*) FILTER (WHERE src = 'n_cn') AS n_cn,
  count(*) FILTER (WHERE src = 'n_can') AS n_can
FROM u WHERE proc_type IS NOT NULL GROUP BY proc_type""")
def proc_type_compare(lake):
    """Procurement-type counts side by side across notices / CN / CAN; missing -> 0."""
    u = reduce(lambda a, b: a.unionByName(b), [
        lake.gold(t).select("proc_type", F.lit(tag).alias("src"))
        for t, tag in (("gold_notices", "n_all"), ("gold_opportunities", "n_cn"), ("gold_awards", "n_can"))])
    return (u.where(F.col("proc_type").isNotNull()).groupBy("proc_type")
            .pivot("src", ["n_all", "n_cn", "n_can"]).count().na.fill(0, ["n_all", "n_cn", "n_can"]))


@query("proc_mix_pct", sql="""
WITH top AS (SELECT buyer_country FROM gold_notices WHERE buyer_country IS NOT NULL GROUP BY 1
             ORDER BY count(*) DESC, buyer_country LIMIT 15),
c AS (SELECT buyer_country, proc_type, count(*) AS n FROM gold_notices
      WHERE buyer_country IN (SELECT buyer_country FROM top) AND proc_type IS NOT NULL GROUP BY 1, 2)
SELECT *, n * 100.0 / sum(n) OVER (PARTITION BY buyer_country) AS pct FROM c""")
def proc_mix_pct(lake):
    """Type mix (row-normalised %) for the 15 busiest countries."""
    g = lake.gold("gold_notices")
    top = (K.value_counts(g, "buyer_country").orderBy(F.col("n").desc(), "buyer_country").limit(15)
           .select("buyer_country"))
    c = (g.join(top, "buyer_country", "left_semi").where(F.col("proc_type").isNotNull())
         .groupBy("buyer_country", "proc_type").agg(F.count(F.lit(1)).alias("n")))
    tot = c.groupBy("buyer_country").agg(F.sum("n").alias("_t"))
    return c.join(tot, "buyer_country").select("buyer_country", "proc_type", "n",
                                               (F.col("n") * 100.0 / F.col("_t")).alias("pct"))


def _in_period(c):
    return (F.col(c) >= F.lit(P0).cast("date")) & (F.col(c) <= F.lit(P1).cast("date"))


def _notices_dated(lake):
    return lake.gold("gold_notices", "notice_id", "notice_type", "pub_date").withColumn("pub_day", F.try_to_date("pub_date"))


def _notices_between(lake, start: str | None, end: str | None):
    """Dated notices from ``start`` to ``end``, both included; by default those of the table's whole range."""
    d = _notices_dated(lake).where(F.col("pub_day").isNotNull())
    if start is not None:
        d = d.where(F.col("pub_day") >= F.lit(start).cast("date"))
    return d if end is None else d.where(F.col("pub_day") <= F.lit(end).cast("date"))


@query("outside_period", sql=f"""
SELECT strftime(date_trunc('month', TRY_CAST(pub_date AS DATE)), '%Y-%m') AS year_month, count(*) AS n
FROM gold_notices
WHERE TRY_CAST(pub_date AS DATE) < DATE '{P0}' OR TRY_CAST(pub_date AS DATE) > DATE '{P1}'
GROUP BY 1""")
def outside_period(lake):
    """Notices published outside the analysis window, by year-month."""
    d = _notices_dated(lake).where(F.col("pub_day").isNotNull() & ~_in_period("pub_day"))
    return d.groupBy(F.date_format(F.trunc("pub_day", "MM"), "yyyy-MM").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("daily_counts", sql="""
SELECT TRY_CAST(pub_date AS DATE) AS pub_day, count(*) AS n_all, count(*) FILTER (WHERE notice_type = 'CN') AS n_cn,
  count(*) FILTER (WHERE notice_type = 'CAN') AS n_can
FROM gold_notices WHERE TRY_CAST(pub_date AS DATE) IS NOT NULL GROUP BY 1""")
def daily_counts(lake, start: str | None = None, end: str | None = None):
    """Daily notice counts (all / CN / CAN); of a window of days, if one is given."""
    d = _notices_between(lake, start, end)
    return d.groupBy("pub_day").agg(F.count(F.lit(1)).alias("n_all"),
                                    F.count_if(F.col("notice_type") == "CN").alias("n_cn"),
                                    F.count_if(F.col("notice_type") == "CAN").alias("n_can"))


@query("dow_counts", sql="""
WITH days AS (SELECT i AS dow, dayname(DATE '2024-01-01' + CAST(i AS INTEGER)) AS day_of_week
              FROM range(7) t(i)),
c AS (SELECT isodow(TRY_CAST(pub_date AS DATE)) - 1 AS dow, count(*) AS n FROM gold_notices
      WHERE TRY_CAST(pub_date AS DATE) IS NOT NULL GROUP BY 1)
SELECT days.dow + 1 AS day_index, day_of_week, COALESCE(n, 0) AS n FROM days LEFT JOIN c ON c.dow = days.dow""")
def dow_counts(lake, start: str | None = None, end: str | None = None):
    """Day-of-week counts, all seven days present (0 filled); of a window of days, if one is given."""
    d = _notices_between(lake, start, end)
    c = d.groupBy(F.weekday("pub_day").alias("dow")).agg(F.count(F.lit(1)).alias("n"))
    days = lake.spark.range(7).select(F.col("id").cast("int").alias("dow"),
                                      F.date_format(F.date_add(F.lit("2024-01-01").cast("date"),
                                                               F.col("id").cast("int")), "EEEE").alias("day_of_week"))
    return (days.join(c, "dow", "left")
            .select((F.col("dow") + 1).cast("bigint").alias("day_index"), "day_of_week",
                    F.coalesce("n", F.lit(0)).alias("n")))


@query("week_counts", sql="""
SELECT weekofyear(TRY_CAST(pub_date AS DATE)) AS iso_week, count(*) AS n FROM gold_notices
WHERE TRY_CAST(pub_date AS DATE) IS NOT NULL GROUP BY 1""")
def week_counts(lake, start: str | None = None, end: str | None = None):
    """ISO-week counts; of a window of days, if one is given."""
    d = _notices_between(lake, start, end)
    return d.groupBy(F.weekofyear("pub_day").cast("bigint").alias("iso_week")).agg(F.count(F.lit(1)).alias("n"))


@query("can_cn_ratio", sql="""
WITH c AS (SELECT buyer_country, count(*) FILTER (WHERE notice_type = 'CN') AS cn_count,
             count(*) FILTER (WHERE notice_type = 'CAN') AS can_count
           FROM gold_notices WHERE buyer_country IS NOT NULL AND notice_type IN ('CN', 'CAN') GROUP BY 1),
r AS (SELECT *, cn_count + can_count AS total,
        CASE WHEN cn_count > 0 THEN can_count * 1.0 / cn_count END AS can_to_cn_ratio FROM c)
SELECT *, CASE WHEN can_to_cn_ratio IS NULL THEN NULL WHEN can_to_cn_ratio <= 0.3 THEN 'Low <0.3'
    WHEN can_to_cn_ratio <= 0.7 THEN 'Medium 0.3-0.7' ELSE 'Good >0.7' END AS coverage,
  can_to_cn_ratio > 1.0 AS above_parity
FROM r WHERE total >= 5""")
def can_cn_ratio(lake):
    """Award-to-open notice ratio per country, banded; countries with >= 5 notices."""
    g = lake.gold("gold_notices").where(F.col("buyer_country").isNotNull() & F.col("notice_type").isin("CN", "CAN"))
    c = g.groupBy("buyer_country").agg(F.count_if(F.col("notice_type") == "CN").alias("cn_count"),
                                       F.count_if(F.col("notice_type") == "CAN").alias("can_count"))
    ratio = F.when(F.col("cn_count") > 0, F.col("can_count") / F.col("cn_count"))
    r = c.withColumns({"total": F.col("cn_count") + F.col("can_count"), "can_to_cn_ratio": ratio})
    band = (F.when(F.col("can_to_cn_ratio").isNull(), None).when(F.col("can_to_cn_ratio") <= 0.3, "Low <0.3")
            .when(F.col("can_to_cn_ratio") <= 0.7, "Medium 0.3-0.7").otherwise("Good >0.7"))
    return (r.where(F.col("total") >= 5)
            .withColumns({"coverage": band, "above_parity": F.col("can_to_cn_ratio") > 1.0})
            .orderBy("can_to_cn_ratio", "buyer_country"))
