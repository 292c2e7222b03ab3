"""Silver-layer operators as named queries (O-SLV-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..operators import silver as S
from ..registry import query


@query("clean_date", sql="""
SELECT notice_id, publication_date,
  substr(regexp_replace(regexp_replace(publication_date, '[+\\-]\\d{2}:\\d{2}$', ''), 'Z$', ''), 1, 10) AS pub_date,
  TRY_CAST(substr(regexp_replace(regexp_replace(publication_date, '[+\\-]\\d{2}:\\d{2}$', ''), 'Z$', ''), 1, 10)
    AS DATE) AS pub_day
FROM src_notices""")
def clean_date(lake):
    """Zone suffix removal + typed date twin."""
    return lake.src("notices").select("notice_id", "publication_date",
                                      C.clean_date("publication_date").alias("pub_date"),
                                      C.to_date_lenient("publication_date").alias("pub_day"))


@query("lenient_cast", sql="""
SELECT notice_id, est_amount, TRY_CAST(est_amount AS DOUBLE) AS estimated,
  CAST(TRY_CAST(est_amount AS DOUBLE) AS BIGINT) IS NOT NULL AS parsed
FROM src_notices""")
def lenient_cast(lake):
    """Lenient number parsing: 'n/a' and NULL become NULL, never an error."""
    v = C.to_double("est_amount")
    return lake.src("notices").select("notice_id", "est_amount", v.alias("estimated"),
                                      v.isNotNull().alias("parsed"))


@query("cpv_division", sql="SELECT notice_id, cpv_code, cpv_division, cpv_division_name FROM s_cpv_codes")
def cpv_division(lake):
    """CPV division and label for every distinct (notice, CPV code)."""
    return lake.silver("cpv_codes").select("notice_id", "cpv_code", "cpv_division", "cpv_division_name")


@query("fill_null_from", sql="SELECT notice_id, tender_id, tender_value, bid_amount FROM s_tenders")
def fill_null_from(lake):
    """bid_amount filled from tender_value when absent."""
    return lake.silver("tenders").select("notice_id", "tender_id", "tender_value", "bid_amount")


@query("date_prefix_filter", sql="""
SELECT notice_id, notice_type, pub_date FROM t_notices WHERE starts_with(pub_date, '1998-01')""")
def date_prefix_filter(lake):
    """Notices published in one month (the DATE_FILTER feature), NULL excluded."""
    t = S.transform_notices(lake.src("notices"), date_prefix="1998-01")
    return t.select("notice_id", "notice_type", "pub_date")


@query("normalise_proc_type", sql="""
SELECT proc_type AS raw_proc_type,
  COALESCE(CASE lower(proc_type) WHEN 'services' THEN 'Services' WHEN 'supplies' THEN 'Supplies'
    WHEN 'works' THEN 'Works' WHEN 'service' THEN 'Services' WHEN 'supply' THEN 'Supplies' END, proc_type)
    AS proc_type, count(*) AS n
FROM src_notices GROUP BY 1, 2""")
def normalise_proc_type(lake):
    """Raw -> normalised procurement type, with row counts."""
    return (lake.src("notices").groupBy(F.col("proc_type").alias("raw_proc_type"),
                                        C.normalise_proc_type("proc_type").alias("proc_type"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("sme_flag", sql="SELECT notice_id, org_id, sme, is_sme FROM s_organisations")
def sme_flag(lake):
    """SME flag from the organisation size word."""
    return lake.silver("organisations").select("notice_id", "org_id", "sme", "is_sme")


@query("awarded_flag", sql="SELECT notice_id, lot_result_id, result_code, is_awarded, result_status FROM s_lot_results")
def awarded_flag(lake):
    """Awarded flag and result status from the result code."""
    return lake.silver("lot_results").select("notice_id", "lot_result_id", "result_code", "is_awarded",
                                             "result_status")


@query("mask_negative", sql="SELECT * FROM s_contracts")
def mask_negative(lake):
    """Contracts with negative values masked, raw value and audit flag kept."""
    return lake.silver("contracts")


@query("silver_tenders", sql="SELECT * FROM s_tenders")
def silver_tenders(lake):
    """Typed, de-duplicated tenders."""
    return lake.silver("tenders")


@query("silver_lot_results", sql="SELECT * FROM s_lot_results")
def silver_lot_results(lake):
    """Typed, de-duplicated lot results."""
    return lake.silver("lot_results")


@query("dedupe_quality", sql="SELECT * FROM s_lots")
def dedupe_quality(lake):
    """Quality-scored dedupe of lots on (notice_id, lot_id)."""
    return lake.silver("lots")


@query("dedupe_stats", sql="""
SELECT CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows, CAST(sum(n - 1) AS BIGINT) AS removed_rows
FROM (SELECT count(*) AS n FROM t_lots GROUP BY notice_id, lot_id)""")
def dedupe_stats(lake):
    """Rows sharing a natural key (keep=False count) and rows the dedupe removes."""
    return S.duplicate_stats(S.transform_lots(lake.src("lots")), ["notice_id", "lot_id"])


@query("enrich_buyers", sql="SELECT * FROM s_notices")
def enrich_buyers(lake):
    """Silver notices with buyer name / country filled from organisations."""
    return lake.silver("notices")


@query("enrich_fill_counts", sql="""
SELECT (SELECT count(buyer_name) FROM s_notices) - (SELECT count(buyer_name) FROM s_notices_raw)
         AS buyer_name_filled,
       (SELECT count(buyer_country) FROM s_notices) - (SELECT count(buyer_country) FROM s_notices_raw)
         AS buyer_country_filled""")
def enrich_fill_counts(lake):
    """How many buyer fields the enrichment filled."""
    return S.enrich_fill_counts(lake.silver_notices_unenriched(), lake.silver("notices"))
