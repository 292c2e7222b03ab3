"""Gold marts and their helpers as named queries (O-GLD-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import gold as G
from ..registry import query
from .oracle_base import add_ctes, mean_rounded_sql


@query("gold_notices", sql="SELECT * FROM gold_notices")
def gold_notices(lake):
    """Notice grain: notice + six child pre-aggregates."""
    return lake.gold("gold_notices")


@query("gold_lots", sql="SELECT * FROM gold_lots")
def gold_lots(lake):
    """Lot grain: lot + result / contract / tender aggregates + notice attributes."""
    return lake.gold("gold_lots")


@query("gold_awards", sql="SELECT * FROM gold_awards")
def gold_awards(lake):
    """Awarded lot results with winner tender, contract and winner organisation."""
    return lake.gold("gold_awards")


@query("best_ranked_tender", sql="SELECT * FROM best_tender")
def best_ranked_tender(lake):
    """Best-ranked tender per lot."""
    return G.best_ranked_tender(lake.silver("tenders"))


_KPI_MEASURES = """
  CAST(COALESCE(sum(lot_count), 0) AS BIGINT) AS lot_count,
  CAST(COALESCE(sum(result_count), 0) AS BIGINT) AS result_count,
  CAST(COALESCE(sum(awarded_lot_count), 0) AS BIGINT) AS awarded_lot_count,
  CAST(COALESCE(sum(contract_count), 0) AS BIGINT) AS contract_count,
  CAST(COALESCE(sum(tender_count), 0) AS BIGINT) AS tender_count,
  sum(CASE WHEN estimated >= 0 THEN estimated END) AS total_estimated,
  sum(CASE WHEN lot_estimated_total >= 0 THEN lot_estimated_total END) AS total_lot_estimated,
  sum(CASE WHEN awarded_amount >= 0 THEN awarded_amount END) AS total_awarded_amount,
  sum(CASE WHEN contract_value >= 0 THEN contract_value END) AS total_contract_value,
  sum(CASE WHEN tender_value >= 0 THEN tender_value END) AS total_tender_value,
  avg(avg_tenders_count) AS avg_tenders_count"""


COUNTRY_KPIS_SQL = f"""
WITH k AS (SELECT COALESCE(buyer_country, 'Unknown') AS buyer_country, count(DISTINCT notice_id) AS notice_count,
    count(*) FILTER (WHERE notice_type = 'CN') AS contract_notice_count,
    count(*) FILTER (WHERE notice_type = 'CAN') AS award_notice_count, {_KPI_MEASURES}
  FROM gold_notices GROUP BY 1),
a AS (SELECT COALESCE(buyer_country, 'Unknown') AS buyer_country, count(lot_result_id) AS award_rows,
    count(DISTINCT winner_org_id) AS winner_count FROM gold_awards GROUP BY 1)
SELECT k.*, COALESCE(a.award_rows, 0) AS award_rows, COALESCE(a.winner_count, 0) AS winner_count
FROM k LEFT JOIN a ON a.buyer_country = k.buyer_country"""

add_ctes([("gold_country_kpis", COUNTRY_KPIS_SQL)])


@query("gold_country_kpis", sql="SELECT * FROM gold_country_kpis")
def gold_country_kpis(lake):
    """Country KPIs over notices and award rows."""
    return lake.gold("gold_country_kpis")


CPV_KPIS_SQL = f"""
WITH k AS (SELECT COALESCE(cpv_division, 'Unknown') AS cpv_division,
    COALESCE(cpv_division_name, 'Unknown') AS cpv_division_name, count(DISTINCT notice_id) AS notice_count,
    count(DISTINCT buyer_country) AS buyer_country_count, {_KPI_MEASURES}
  FROM gold_notices GROUP BY 1, 2),
a AS (SELECT COALESCE(cpv_division, 'Unknown') AS cpv_division,
    COALESCE(cpv_division_name, 'Unknown') AS cpv_division_name, count(lot_result_id) AS award_rows,
    count(DISTINCT winner_org_id) AS winner_count FROM gold_awards GROUP BY 1, 2)
SELECT k.*, COALESCE(a.award_rows, 0) AS award_rows, COALESCE(a.winner_count, 0) AS winner_count
FROM k LEFT JOIN a ON a.cpv_division = k.cpv_division AND a.cpv_division_name = k.cpv_division_name"""

add_ctes([("gold_cpv_kpis", CPV_KPIS_SQL)])


@query("gold_cpv_kpis", sql="SELECT * FROM gold_cpv_kpis")
def gold_cpv_kpis(lake):
    """CPV-division KPIs over notices and award rows."""
    return lake.gold("gold_cpv_kpis")


@query("gold_opportunities", sql="SELECT * FROM gold_opportunities")
def gold_opportunities(lake):
    """Open contract notices with lot count / duration; estimate falls back to lot total."""
    return lake.gold("gold_opportunities")


@query("gold_notice_awards", sql="SELECT * FROM gold_notice_awards")
def gold_notice_awards(lake):
    """Award notices at notice grain with winners, competition and savings."""
    return lake.gold("gold_notice_awards")


_MS_MEASURES = """count(notice_id) AS notice_count, COALESCE(sum(estimated), 0) AS total_estimated,
  COALESCE(sum(awarded_eur), 0) AS total_awarded, """ + mean_rounded_sql("savings_pct") + """ AS avg_savings_pct,
  """ + mean_rounded_sql("avg_tenders_per_lot") + """ AS avg_tenders,
  count(*) FILTER (WHERE sme_winner) AS sme_winner_count"""


@query("gold_market_summary", sql=f"""
SELECT buyer_country AS dimension_value, {_MS_MEASURES}, 'buyer_country' AS dimension
FROM gold_notice_awards WHERE buyer_country IS NOT NULL GROUP BY buyer_country
UNION ALL
SELECT cpv_division_name, {_MS_MEASURES}, 'cpv_division_name'
FROM gold_notice_awards WHERE cpv_division_name IS NOT NULL GROUP BY cpv_division_name
UNION ALL
SELECT proc_type, {_MS_MEASURES}, 'proc_type' FROM gold_notice_awards WHERE proc_type IS NOT NULL GROUP BY proc_type""")
def gold_market_summary(lake):
    """Same measures by country, CPV label and type, stacked (GROUPING SETS)."""
    return lake.gold("gold_market_summary")


@query("gold_cpv_analysis", sql=f"""
WITH aw AS (SELECT cpv_division, cpv_division_name, count(notice_id) AS awards_count,
    COALESCE(sum(awarded_eur), 0) AS total_awarded, {mean_rounded_sql("savings_pct")} AS avg_savings,
    {mean_rounded_sql("avg_tenders_per_lot")} AS avg_competition, count(*) FILTER (WHERE sme_winner) AS sme_wins
  FROM gold_notice_awards WHERE cpv_division IS NOT NULL AND cpv_division_name IS NOT NULL GROUP BY 1, 2),
op AS (SELECT cpv_division, cpv_division_name, count(notice_id) AS open_notices,
    COALESCE(sum(estimated), 0) AS total_open_est
  FROM gold_opportunities WHERE cpv_division IS NOT NULL AND cpv_division_name IS NOT NULL GROUP BY 1, 2)
SELECT COALESCE(aw.cpv_division, op.cpv_division) AS cpv_division,
  COALESCE(aw.cpv_division_name, op.cpv_division_name) AS cpv_division_name, awards_count, total_awarded,
  avg_savings, avg_competition, sme_wins, open_notices, total_open_est
FROM aw FULL OUTER JOIN op ON aw.cpv_division = op.cpv_division AND aw.cpv_division_name = op.cpv_division_name""")
def gold_cpv_analysis(lake):
    """Award stats full-outer-joined to open-notice stats by CPV division."""
    return lake.gold("gold_cpv_analysis")


@query("market_by_country", sql="""
SELECT buyer_country, COALESCE(sum(awarded_eur), 0) AS total_awarded, avg(savings_pct) AS avg_savings_pct
FROM gold_notice_awards WHERE buyer_country IS NOT NULL GROUP BY buyer_country""")
def market_by_country(lake):
    """Derived market table: awarded value and mean savings by country."""
    return (lake.gold("gold_notice_awards").where(F.col("buyer_country").isNotNull())
            .groupBy("buyer_country")
            .agg(G.zero_sum("awarded_eur").alias("total_awarded"), F.avg("savings_pct").alias("avg_savings_pct"))
            .orderBy(F.col("total_awarded").desc()))


@query("cpv_by_competition", sql="""
SELECT cpv_division_name, avg(avg_tenders_per_lot) AS avg_competition,
  count(*) FILTER (WHERE sme_winner) AS sme_wins, COALESCE(sum(awarded_eur), 0) AS total_awarded
FROM gold_notice_awards WHERE cpv_division_name IS NOT NULL GROUP BY cpv_division_name""")
def cpv_by_competition(lake):
    """Derived CPV table: competition, SME wins and value by CPV label."""
    return (lake.gold("gold_notice_awards").where(F.col("cpv_division_name").isNotNull())
            .groupBy("cpv_division_name")
            .agg(F.avg("avg_tenders_per_lot").alias("avg_competition"),
                 F.count_if(F.col("sme_winner")).alias("sme_wins"),
                 G.zero_sum("awarded_eur").alias("total_awarded"))
            .orderBy(F.col("avg_competition").desc_nulls_last()))


#: The columns of the award view and those of gold_awards that they are made of.
AWARD_VIEW = {
    **{c: (c,) for c in ("notice_id", "lot_id", "lot_result_id", "buyer_country", "proc_type", "cpv_division", "cpv_division_name",
                         "estimated")},
    "awarded_eur": ("awarded_amount",), "award_date": ("contract_date",), "avg_tenders_per_lot": ("tenders_count",),
    "savings_pct": ("estimated", "awarded_amount"), "sme_winner": ("sme_tenders",), "num_lots": ("notice_id",)}


def award_view_df(lake, *columns: str):
    """Reader-side award normalisation (renames, clipped savings, SME, lots); with ``columns`` only these, of no more of
    gold_awards than they need."""
    names = columns or tuple(AWARD_VIEW)
    aw = lake.gold("gold_awards", *sorted({c for n in columns for c in AWARD_VIEW[n]}))
    est = C.to_double("estimated")
    awd = C.to_double("awarded_amount")
    sav = F.try_divide(est - awd, est) * 100
    made = {
        "awarded_eur": lambda: awd, "award_date": lambda: F.col("contract_date"),
        "avg_tenders_per_lot": lambda: F.col("tenders_count"),
        "savings_pct": lambda: F.when(sav.isNotNull(), F.greatest(F.lit(-100.0), F.least(F.lit(100.0), sav))),
        "sme_winner": lambda: (F.coalesce(C.to_double("sme_tenders"), F.lit(0.0)) > 0).cast("int"),
        "num_lots": lambda: F.lit(1)}
    return aw.select(*[made[n]().alias(n) if n in made else F.col(n) for n in names])


@query("award_view", sql="""
SELECT notice_id, lot_id, lot_result_id, buyer_country, proc_type, cpv_division, cpv_division_name, estimated,
  awarded_amount AS awarded_eur, contract_date AS award_date, tenders_count AS avg_tenders_per_lot,
  CASE WHEN estimated <> 0 AND awarded_amount IS NOT NULL
    THEN greatest(-100.0, least(100.0, (estimated - awarded_amount) / estimated * 100)) END AS savings_pct,
  CAST(COALESCE(CAST(sme_tenders AS DOUBLE), 0.0) > 0 AS INTEGER) AS sme_winner, 1 AS num_lots
FROM gold_awards""")
def award_view(lake):
    """Award rows normalised for readers."""
    return award_view_df(lake)


@query("non_negative_sum", sql="""
SELECT notice_id, sum(CASE WHEN contract_value_raw >= 0 THEN contract_value_raw END) AS value_sum,
  avg(CASE WHEN contract_value_raw >= 0 THEN contract_value_raw END) AS value_mean,
  count(*) FILTER (WHERE contract_value_raw < 0) AS negative_rows
FROM s_contracts GROUP BY notice_id""")
def non_negative_sum(lake):
    """Null-safe sum / mean over non-negative values only; NULL when none."""
    return lake.silver("contracts").groupBy("notice_id").agg(
        F.sum(C.non_negative("contract_value_raw")).alias("value_sum"),
        F.avg(C.non_negative("contract_value_raw")).alias("value_mean"),
        F.count_if(F.col("contract_value_raw") < 0).alias("negative_rows"))


@query("unique_join", sql="""
SELECT notice_id, array_to_string(list_sort(list_distinct(list(org_country))), ', ') AS countries
FROM s_organisations WHERE org_country <> '' GROUP BY notice_id""")
def unique_join(lake):
    """Sorted distinct organisation countries per notice."""
    return (lake.silver("organisations").where(F.col("org_country") != "").groupBy("notice_id")
            .agg(G.unique_join("org_country").alias("countries")))


@query("min_date", sql="""
SELECT lot_result_id, min(CASE WHEN substr(contract_date, 1, 10) NOT IN ('', 'None', 'nan', 'NaT', '<NA>')
  THEN substr(contract_date, 1, 10) END) AS first_contract_date
FROM s_contracts GROUP BY lot_result_id""")
def min_date(lake):
    """Earliest non-empty contract date per result id."""
    return lake.silver("contracts").groupBy("lot_result_id").agg(G.min_date("contract_date")
                                                                  .alias("first_contract_date"))
