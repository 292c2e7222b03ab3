"""Dashboard / assistant aggregates re-aimed as parameterised jobs (O-QRY-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import query
from . import common as K
from ..operators import gold as G
from ..operators import silver as S
from ..operators.gold import mean_rounded, round_half_even
from .gold_queries import AWARD_VIEW, award_view_df
from .oracle_base import mean_rounded_sql, round_sql

AV_SQL = """av AS (SELECT notice_id, lot_id, lot_result_id, buyer_country, proc_type, cpv_division, cpv_division_name,
  estimated, awarded_amount AS awarded_eur, contract_date AS award_date, tenders_count AS avg_tenders_per_lot,
  CASE WHEN estimated <> 0 AND awarded_amount IS NOT NULL
    THEN greatest(-100.0, least(100.0, (estimated - awarded_amount) / estimated * 100)) END AS savings_pct,
  CAST(COALESCE(CAST(sme_tenders AS DOUBLE), 0.0) > 0 AS INTEGER) AS sme_winner, 1 AS num_lots FROM gold_awards)"""

# Example selection for the registered filter query (any lists work; empty = no filter).
EXAMPLE_TYPES = ["Works", "Services"]


def apply_filters(df: DataFrame, countries=None, types=None, cpvs=None) -> DataFrame:
    """Three optional IN filters; an empty list means no filter; a filter on a
    column the frame lacks is ignored."""
    for col, values in (("buyer_country", countries), ("proc_type", types), ("cpv_division_name", cpvs)):
        if values and col in df.columns:
            df = df.where(F.col(col).isin(*values))
    return df


@query("filtered_opportunities", sql="SELECT * FROM gold_opportunities WHERE proc_type IN ("
       + ", ".join(f"'{t}'" for t in EXAMPLE_TYPES) + ")")
def filtered_opportunities(lake, countries=None, types=tuple(EXAMPLE_TYPES), cpvs=None):
    """Open notices after the sidebar filters (country / type / CPV)."""
    return apply_filters(lake.gold("gold_opportunities"), countries, list(types or []), cpvs)


@query("filter_options", sql="""
SELECT 'buyer_country' AS option, buyer_country AS value FROM gold_opportunities WHERE buyer_country IS NOT NULL
UNION SELECT 'buyer_country', buyer_country FROM gold_awards WHERE buyer_country IS NOT NULL
UNION SELECT 'proc_type', proc_type FROM gold_opportunities WHERE proc_type IS NOT NULL
UNION SELECT 'proc_type', proc_type FROM gold_awards WHERE proc_type IS NOT NULL
UNION SELECT 'cpv_division_name', cpv_division_name FROM gold_opportunities WHERE cpv_division_name IS NOT NULL
UNION SELECT 'cpv_division_name', cpv_division_name FROM gold_awards WHERE cpv_division_name IS NOT NULL""")
def filter_options(lake):
    """Sorted filter options = union of distinct values over opportunities and awards."""
    parts = [lake.gold(t).where(F.col(c).isNotNull()).select(F.lit(c).alias("option"), F.col(c).alias("value"))
             for c in ("buyer_country", "proc_type", "cpv_division_name")
             for t in ("gold_opportunities", "gold_awards")]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct().orderBy("option", "value")


@query("opportunity_kpis", sql="""
SELECT count(*) AS n_opportunities, median(estimated) AS median_estimate, COALESCE(sum(estimated), 0) AS total_estimate,
  count(DISTINCT buyer_country) AS n_countries, count(DISTINCT cpv_division_name) AS n_divisions,
  avg(num_lots) AS mean_lots FROM gold_opportunities""")
def opportunity_kpis(lake):
    """Opportunity tiles: count, median / total estimate, countries, divisions, mean lots."""
    o = lake.gold("gold_opportunities")
    return o.agg(F.count(F.lit(1)).alias("n_opportunities"),
                 F.coalesce(F.sum("estimated"), F.lit(0.0)).alias("total_estimate"),
                 F.count_distinct("buyer_country").alias("n_countries"),
                 F.count_distinct("cpv_division_name").alias("n_divisions"), F.avg("num_lots").alias("mean_lots")).withColumn("median_estimate", K.median_of(o, "estimated"))


@query("award_kpis", sql=f"""WITH {AV_SQL}
SELECT count(*) AS n_awards, COALESCE(sum(awarded_eur), 0) AS total_awarded, median(savings_pct) AS median_savings,
  avg(savings_pct) AS mean_savings, avg(sme_winner) * 100 AS sme_rate_pct, avg(avg_tenders_per_lot) AS mean_bidders
FROM av""")
def award_kpis(lake):
    """Award tiles: count, total, median / mean savings, SME %, mean bidders."""
    a = award_view_df(lake)
    return a.agg(F.count(F.lit(1)).alias("n_awards"), F.coalesce(F.sum("awarded_eur"), F.lit(0.0)).alias("total_awarded"),
                 F.avg("savings_pct").alias("mean_savings"), (F.avg("sme_winner") * 100).alias("sme_rate_pct"),
                 F.avg("avg_tenders_per_lot").alias("mean_bidders")).withColumn("median_savings", K.median_of(a, "savings_pct"))


@query("top_countries", sql=f"""WITH {AV_SQL},
c AS (SELECT 'opportunities' AS source, buyer_country, count(*) AS n FROM gold_opportunities
      WHERE buyer_country IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'awards', buyer_country, count(*) FROM av WHERE buyer_country IS NOT NULL GROUP BY 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, buyer_country) AS rank FROM c)
WHERE rank <= 20""")
def top_countries(lake):
    """Top-20 countries by notice volume (opportunities) and by award lot rows."""
    o = K.value_counts(lake.gold("gold_opportunities"), "buyer_country").withColumn("source", F.lit("opportunities"))
    a = K.value_counts(award_view_df(lake), "buyer_country").withColumn("source", F.lit("awards"))
    return K.top_k(o.unionByName(a), 20, F.col("n").desc(), F.col("buyer_country"), partition=["source"])


@query("top_cpv_estimate", sql="""
SELECT cpv_division_name, count(notice_id) AS n, COALESCE(sum(estimated), 0) AS total_est FROM gold_opportunities
WHERE cpv_division_name IS NOT NULL GROUP BY 1 ORDER BY total_est DESC, cpv_division_name LIMIT 15""")
def top_cpv_estimate(lake):
    """CPV divisions by total open estimate, top 15."""
    g = (lake.gold("gold_opportunities").where(F.col("cpv_division_name").isNotNull()).groupBy("cpv_division_name")
         .agg(F.count("notice_id").alias("n"), F.coalesce(F.sum("estimated"), F.lit(0.0)).alias("total_est")))
    return g.orderBy(F.col("total_est").desc(), "cpv_division_name").limit(15)


@query("largest_open", sql="""
SELECT notice_id, buyer_name, buyer_country, proc_type, cpv_division_name, estimated, num_lots FROM gold_opportunities
ORDER BY estimated DESC NULLS LAST, notice_id LIMIT 50""")
def largest_open(lake):
    """The 50 largest open opportunities by estimate."""
    return (lake.gold("gold_opportunities")
            .select("notice_id", "buyer_name", "buyer_country", "proc_type", "cpv_division_name", "estimated",
                    "num_lots")
            .orderBy(F.col("estimated").desc_nulls_last(), "notice_id").limit(50))


@query("largest_awards", sql="""
SELECT notice_id, buyer_name, buyer_country, cpv_division_name, estimated, awarded_eur, savings_pct,
  avg_tenders_per_lot, winner_names, winner_countries, sme_winner FROM gold_notice_awards
ORDER BY awarded_eur DESC NULLS LAST, notice_id LIMIT 100""")
def largest_awards(lake):
    """The 100 largest awards by value (notice grain)."""
    return (lake.gold("gold_notice_awards")
            .select("notice_id", "buyer_name", "buyer_country", "cpv_division_name", "estimated", "awarded_eur",
                    "savings_pct", "avg_tenders_per_lot", "winner_names", "winner_countries", "sme_winner")
            .orderBy(F.col("awarded_eur").desc_nulls_last(), "notice_id").limit(100))


@query("bidders_by_type", sql=f"""WITH {AV_SQL}
SELECT proc_type, avg(avg_tenders_per_lot) AS mean_bidders, median(avg_tenders_per_lot) AS median_bidders
FROM av WHERE proc_type IS NOT NULL GROUP BY proc_type""")
def bidders_by_type(lake):
    """Mean / median bidders by procurement type."""
    return (award_view_df(lake).where(F.col("proc_type").isNotNull()).groupBy("proc_type")
            .agg(F.avg("avg_tenders_per_lot").alias("mean_bidders"),
                 F.median("avg_tenders_per_lot").alias("median_bidders")))


@query("bidders_by_cpv", sql=f"""WITH {AV_SQL}
SELECT cpv_division_name, avg(avg_tenders_per_lot) AS mean_bidders FROM av WHERE cpv_division_name IS NOT NULL
GROUP BY 1 ORDER BY mean_bidders DESC NULLS LAST, cpv_division_name LIMIT 12""")
def bidders_by_cpv(lake):
    """Mean bidders by CPV division, top 12."""
    g = (award_view_df(lake).where(F.col("cpv_division_name").isNotNull()).groupBy("cpv_division_name")
         .agg(F.avg("avg_tenders_per_lot").alias("mean_bidders")))
    return g.orderBy(F.col("mean_bidders").desc_nulls_last(), "cpv_division_name").limit(12)


@query("sme_rate_by_cpv", sql=f"""WITH {AV_SQL}
SELECT cpv_division_name, avg(sme_winner) AS sme_rate, count(*) AS n FROM av WHERE cpv_division_name IS NOT NULL
GROUP BY 1 HAVING count(*) >= 5""")
def sme_rate_by_cpv(lake):
    """SME win rate by CPV division (>= 5 award rows)."""
    g = (award_view_df(lake).where(F.col("cpv_division_name").isNotNull()).groupBy("cpv_division_name")
         .agg(F.avg("sme_winner").alias("sme_rate"), F.count(F.lit(1)).alias("n")))
    return g.where(F.col("n") >= 5).orderBy(F.col("sme_rate").desc(), "cpv_division_name")


N_BINS = 40


@query("savings_histogram", sql=f"""WITH {AV_SQL},
v AS (SELECT savings_pct AS x FROM av WHERE savings_pct IS NOT NULL),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
b AS (SELECT CASE WHEN r.hi = r.lo THEN 1 ELSE least({N_BINS}, CAST(floor((x - r.lo) / (r.hi - r.lo) * {N_BINS}) AS BIGINT) + 1)
             END AS bin, count(*) AS n FROM v, r GROUP BY 1)
SELECT bins.i AS bin, r.lo + (bins.i - 1) * (r.hi - r.lo) / {N_BINS} AS bin_start,
  r.lo + bins.i * (r.hi - r.lo) / {N_BINS} AS bin_end, COALESCE(b.n, 0) AS n
FROM range(1, {N_BINS + 1}) AS bins(i), r LEFT JOIN b ON b.bin = bins.i""")
def savings_histogram(lake, n_bins: int = N_BINS):
    """Savings histogram with equal-width bins between min and max (max in the last bin)."""
    v = award_view_df(lake, "savings_pct").where(F.col("savings_pct").isNotNull()).select(F.col("savings_pct").alias("x"))
    lo, hi = K.total(v, F.min("x")), K.total(v, F.max("x"))
    idx = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.lit(n_bins), F.floor((F.col("x") - lo) / (hi - lo) * n_bins).cast("bigint") + 1))
    b = v.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = lake.spark.range(1, n_bins + 1).select(F.col("id").alias("bin"))
    return bins.join(b, "bin", "left").select(
        "bin", (lo + (F.col("bin") - 1) * (hi - lo) / n_bins).alias("bin_start"),
        (lo + F.col("bin") * (hi - lo) / n_bins).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("n"))


@query("scatter_sample", sql=f"""WITH {AV_SQL}
SELECT * FROM av WHERE awarded_eur > 0 AND estimated > 0
ORDER BY md5(concat_ws('/', '42', notice_id, lot_result_id)), notice_id, lot_result_id LIMIT 800""")
def scatter_sample(lake, k: int = 800, seed: int = 42):
    """Repeatable sample of at most ``k`` awards with positive estimate and value
    (the sample is the feature): order by a seeded hash, keep k."""
    a = award_view_df(lake, *AWARD_VIEW).where((F.col("awarded_eur") > 0) & (F.col("estimated") > 0))
    return (a.withColumn("_h", F.md5(F.concat_ws("/", F.lit(str(seed)), "notice_id", "lot_result_id")))
            .orderBy("_h", "notice_id", "lot_result_id").limit(k).drop("_h"))


# ---------------------------------------------------------------- canned questions

@query("qq1_top_award_countries", sql="""
WITH c AS (SELECT buyer_country, count(*) AS n FROM gold_notice_awards WHERE buyer_country IS NOT NULL GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, buyer_country) AS rank,
        n * 100.0 / (SELECT count(*) FROM gold_notice_awards) AS share_pct FROM c)
SELECT *, (SELECT sum(share_pct) FROM r WHERE rank <= 2) AS top2_share_pct FROM r WHERE rank <= 5""")
def qq1_top_award_countries(lake):
    """Top-5 countries by award notices, their share and the share of the top two."""
    aw = lake.gold("gold_notice_awards")
    top = K.top_k(K.value_counts(aw, "buyer_country"), 5, F.col("n").desc(), F.col("buyer_country"))
    top = top.withColumn("share_pct", F.col("n") * 100.0 / K.total(aw))
    top2 = top.where(F.col("rank") <= 2).select(F.sum("share_pct")).scalar()
    return top.withColumn("top2_share_pct", top2)


@query("qq2_cpv_savings", sql="""
SELECT cpv_division_name, avg(savings_pct) AS avg_savings FROM gold_notice_awards WHERE cpv_division_name IS NOT NULL
GROUP BY 1 HAVING avg(savings_pct) IS NOT NULL ORDER BY avg_savings DESC, cpv_division_name LIMIT 5""")
def qq2_cpv_savings(lake):
    """CPV divisions with the highest mean savings, top 5."""
    g = (lake.gold("gold_notice_awards").where(F.col("cpv_division_name").isNotNull()).groupBy("cpv_division_name")
         .agg(F.avg("savings_pct").alias("avg_savings")).where(F.col("avg_savings").isNotNull()))
    return g.orderBy(F.col("avg_savings").desc(), "cpv_division_name").limit(5)


@query("qq3_sme_share", sql="""
SELECT avg(CAST(sme_winner AS INTEGER)) * 100 AS sme_rate_pct, count(*) FILTER (WHERE sme_winner) AS n_sme,
  count(*) AS n_total FROM gold_notice_awards""")
def qq3_sme_share(lake):
    """Share of award notices won by an SME."""
    return lake.gold("gold_notice_awards").agg(
        (F.avg(F.col("sme_winner").cast("int")) * 100).alias("sme_rate_pct"),
        F.count_if(F.col("sme_winner")).alias("n_sme"), F.count(F.lit(1)).alias("n_total"))


@query("qq4_bids_per_lot", sql="""
SELECT cpv_division_name, """ + mean_rounded_sql("avg_tenders_per_lot") + """ AS avg_bids FROM gold_notice_awards
WHERE cpv_division_name IS NOT NULL GROUP BY 1 HAVING avg(avg_tenders_per_lot) IS NOT NULL
ORDER BY avg(avg_tenders_per_lot) DESC, cpv_division_name LIMIT 6""")
def qq4_bids_per_lot(lake):
    """Most contested CPV divisions by mean bids per lot, top 6."""
    g = (lake.gold("gold_notice_awards").where(F.col("cpv_division_name").isNotNull()).groupBy("cpv_division_name")
         .agg(F.avg("avg_tenders_per_lot").alias("_m"), mean_rounded("avg_tenders_per_lot").alias("avg_bids"))
         .where(F.col("_m").isNotNull()))
    return (g.orderBy(F.col("_m").desc(), "cpv_division_name").limit(6)
            .select("cpv_division_name", "avg_bids"))


@query("qq5_open_value", sql="""
SELECT COALESCE(sum(estimated), 0) AS total_estimated, count(*) AS n_open, median(estimated) AS median_estimated
FROM gold_opportunities""")
def qq5_open_value(lake):
    """Total and median estimate of open tenders."""
    o = lake.gold("gold_opportunities")
    return o.agg(F.coalesce(F.sum("estimated"), F.lit(0.0)).alias("total_estimated"), F.count(F.lit(1)).alias("n_open")).withColumn(
        "median_estimated", K.median_of(o, "estimated"))


@query("qq6_savings_by_type", sql="""
SELECT proc_type, """ + round_sql("median(savings_pct)") + """ AS median_savings,
  """ + mean_rounded_sql("savings_pct") + """ AS mean_savings,
  count(*) AS n_contracts FROM gold_notice_awards WHERE proc_type IS NOT NULL GROUP BY 1""")
def qq6_savings_by_type(lake):
    """Savings by procurement type: median, mean, count."""
    a = lake.gold("gold_notice_awards").where(F.col("proc_type").isNotNull())
    g = a.groupBy("proc_type").agg(mean_rounded("savings_pct").alias("mean_savings"), F.count(F.lit(1)).alias("n_contracts"))
    return K.with_medians(g, a, ["proc_type"], {"median_savings": "savings_pct"}).withColumn(
        "median_savings", round_half_even("median_savings"))


@query("qq7_largest_mean_tender", sql="""
SELECT buyer_country, avg(estimated) AS mean_estimated FROM gold_opportunities WHERE buyer_country IS NOT NULL
GROUP BY 1 HAVING avg(estimated) IS NOT NULL ORDER BY mean_estimated DESC, buyer_country LIMIT 5""")
def qq7_largest_mean_tender(lake):
    """Countries with the largest mean open-tender estimate, top 5."""
    g = (lake.gold("gold_opportunities").where(F.col("buyer_country").isNotNull()).groupBy("buyer_country")
         .agg(F.avg("estimated").alias("mean_estimated")).where(F.col("mean_estimated").isNotNull()))
    return g.orderBy(F.col("mean_estimated").desc(), "buyer_country").limit(5)


@query("qq8_cpv_value", sql="""
SELECT cpv_division_name, COALESCE(sum(awarded_eur), 0) AS total_awarded FROM gold_notice_awards
WHERE cpv_division_name IS NOT NULL GROUP BY 1 ORDER BY total_awarded DESC, cpv_division_name LIMIT 10""")
def qq8_cpv_value(lake):
    """CPV divisions by total awarded value, top 10."""
    g = (lake.gold("gold_notice_awards").where(F.col("cpv_division_name").isNotNull()).groupBy("cpv_division_name")
         .agg(F.coalesce(F.sum("awarded_eur"), F.lit(0.0)).alias("total_awarded")))
    return g.orderBy(F.col("total_awarded").desc(), "cpv_division_name").limit(10)


def money_label(c):
    """Compact money label as a column expression: EUR x.xB / x.xM / xK / x."""
    v = F.col(c) if isinstance(c, str) else c
    return (F.when(v.isNull(), None)
            .when(v >= 1e9, F.format_string("€%.1fB", v / 1e9))
            .when(v >= 1e6, F.format_string("€%.1fM", v / 1e6))
            .when(v >= 1e3, F.format_string("€%.0fK", v / 1e3))
            .otherwise(F.format_string("€%.0f", v)))


@query("fmt_eur", sql="""
SELECT notice_id, awarded_eur, CASE WHEN awarded_eur IS NULL THEN NULL
  WHEN awarded_eur >= 1e9 THEN printf('€%.1fB', awarded_eur / 1e9)
  WHEN awarded_eur >= 1e6 THEN printf('€%.1fM', awarded_eur / 1e6)
  WHEN awarded_eur >= 1e3 THEN printf('€%.0fK', awarded_eur / 1e3)
  ELSE printf('€%.0f', awarded_eur) END AS awarded_label
FROM gold_notice_awards""")
def fmt_eur(lake):
    """Awarded value of every award notice with its compact money label."""
    return lake.gold("gold_notice_awards").select("notice_id", "awarded_eur",
                                                  money_label("awarded_eur").alias("awarded_label"))


# ---------------------------------------------------------------- catalog / SQL surface

@query("table_catalog")
def table_catalog(lake):
    """Schema summary of every silver table and gold mart: rows, columns, column list."""
    from ..context import Lake
    from ..sources.catalog import GOLD, SILVER
    whole = Lake(lake.spark, lake.sf_dir, xml=lake.xml)  # plans only, for their schemas: nothing of it runs
    frames = {**{f"silver_{t}": whole.silver(t) for t in SILVER}, **{g: whole.gold(g) for g in GOLD}}
    counted = _catalog_rows(lake, {n: df.schema for n, df in frames.items()})
    parts = []
    for name, df in frames.items():
        cols = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields)
        parts.append(counted[name].agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
            F.lit(cols).alias("columns")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _catalog_rows(lake, schemas: dict) -> dict[str, DataFrame]:
    """The rows of every silver table and mart, built as far as says how many there are: silver tables that no mart's rows depend
    on by their keys, marts without the columns that are joined to their rows, summaries by their own builders over the
    columns that they group by."""
    # Which rows of a mart there are depends on decided rows of these tables.
    decided = ("notices", "organisations", "lot_results")
    rows = {f"silver_{t}": lake.silver(t) if t in decided else lake.silver_keys(t) for t in S.TRANSFORMS}

    def grouped(mart: str, *keys: str) -> DataFrame:
        """A mart with the columns ``keys``; the others, which only measures are made of, are null."""
        have = lake.gold(mart, "notice_id", *keys)
        return have.select(*[F.col(f.name) if f.name in have.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas[mart]])

    def nothing_of(mart: str) -> DataFrame:
        """For what is joined from the left on the groups: it adds no rows."""
        return lake.spark.createDataFrame([], schemas[mart])

    cpv = ("cpv_division", "cpv_division_name")
    return rows | {
        **{m: lake.gold(m, "notice_id") for m in ("gold_notices", "gold_awards", "gold_opportunities", "gold_notice_awards")},
        "gold_lots": rows["silver_lots"],  # a row for each lot
        "gold_country_kpis": G.build_country_kpis(grouped("gold_notices", "buyer_country"), nothing_of("gold_awards")),
        "gold_cpv_kpis": G.build_cpv_kpis(grouped("gold_notices", *cpv), nothing_of("gold_awards")),
        "gold_market_summary": G.build_market_summary(grouped("gold_notice_awards", "buyer_country", "cpv_division_name", "proc_type")),
        "gold_cpv_analysis": G.build_cpv_analysis(grouped("gold_notice_awards", *cpv), grouped("gold_opportunities", *cpv))}


@query("newest_file")
def newest_file(lake):
    """The most recently modified candidate input file (by file metadata), with its row count."""
    from ..sources.catalog import newest
    n = newest(lake.spark, lake.sf_dir)
    return n.withColumn("n_rows", lake.spark.read.parquet(n.first().path).select(F.count(F.lit(1))).scalar())


SQL_SURFACE_EXAMPLE = """
SELECT buyer_country, count(*) AS n, sum(awarded_eur) AS total_awarded
FROM gold_notice_awards WHERE buyer_country IS NOT NULL GROUP BY buyer_country"""


@query("sql_over_views", sql=SQL_SURFACE_EXAMPLE)
def sql_over_views(lake, statement: str = SQL_SURFACE_EXAMPLE):
    """Free-form question over the registered layers with spark.sql (the assistant's tool, without eval); a statement that is
    more than a query is refused."""
    from ..sources.catalog import read_only, register_views
    read_only(lake.spark, statement)
    register_views(lake, statement=statement)
    return lake.spark.sql(statement)
