"""DuckDB oracle: the procurement views, silver and gold layers as SQL CTEs.

This is an independent statement of the same semantics in plain SQL (window
``ROW_NUMBER`` for dedupe, correlated-free left joins, etc.), used only to
cross-check the DataFrame implementation on the driver tables.
"""

from __future__ import annotations

from ..functions.lookups import CPV_DIVISIONS, DEDUPE_DATE_COLUMNS, QUALITY_VALUE_COLUMNS, SME_VALUES


def mean_rounded_sql(x: str, scale: int = 1) -> str:
    return f"CAST(round_even(CAST(avg(CAST({x} AS DECIMAL(38,10))) AS DECIMAL(38,14)), {scale}) AS DOUBLE)"


def round_sql(x: str, scale: int = 1) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(38,14)), {scale}) AS DOUBLE)"


def _nn(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN {x} END"


def _dedupe(source: str, key: list[str], cols: list[str], order_cols: list[str] | None = None) -> str:
    """Quality-score dedupe as a ROW_NUMBER window."""
    rest = [c for c in cols if c not in key]
    if order_cols is None:
        order_cols = ["source_order"] if "source_order" in cols else rest
    score = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)
    for v in QUALITY_VALUE_COLUMNS:
        if v in cols:
            score += (f" + (CASE WHEN TRY_CAST({v} AS DOUBLE) >= 0 THEN 3 "
                      f"WHEN TRY_CAST({v} AS DOUBLE) < 0 THEN -3 ELSE 0 END)")
    order = [f"({score}) DESC"]
    for d in DEDUPE_DATE_COLUMNS:
        if d in cols:
            order.append(f"TRY_CAST({d} AS TIMESTAMP) DESC NULLS LAST")
    order += [f"{c} DESC NULLS LAST" for c in order_cols]
    sel = ", ".join(cols)
    return (f"SELECT {sel} FROM (SELECT {sel}, ROW_NUMBER() OVER (PARTITION BY {', '.join(key)} "
            f"ORDER BY {', '.join(order)}) AS _rn FROM {source}) WHERE _rn = 1")


_CPV = ", ".join(f"('{k}', '{v}')" for k, v in CPV_DIVISIONS.items())
_SME = ", ".join(f"'{v}'" for v in SME_VALUES)

_NOTICE_COLS = ["notice_id", "notice_type", "pub_date", "buyer_org_id", "buyer_name", "buyer_country",
                "project_title", "proc_type", "procedure_type", "cpv_main", "cpv_division", "cpv_division_name",
                "estimated", "estimated_value", "est_currency", "total_awarded", "submission_deadline", "framework",
                "source_file"]
_LOT_COLS = ["notice_id", "lot_id", "lot_est", "duration_val", "lot_date", "source_order"]
_ORG_COLS = ["notice_id", "org_id", "org_name", "org_country", "sme", "source_order", "is_sme"]
_LR_COLS = ["notice_id", "lot_result_id", "lot_id", "result_code", "tenders_count", "winner_org_id",
            "awarded_amount", "winner_tender_id", "sme_tenders", "award_currency", "is_awarded", "result_status"]
_TENDER_COLS = ["notice_id", "tender_id", "lot_id", "tendering_party_id", "tender_value", "is_ranked", "rank",
                "bid_date", "bid_amount", "subcontracting", "tender_currency", "subcontracting_pct"]
_CONTRACT_COLS = ["notice_id", "lot_result_id", "contract_id", "contract_value", "contract_date",
                  "contract_value_raw", "contract_value_was_negative_source"]
_CPV_COLS = ["notice_id", "cpv_code", "cpv_division", "cpv_division_name"]

BASE_CTES: list[tuple[str, str]] = [
    ("cpv_lookup", f"SELECT * FROM (VALUES {_CPV}) AS t(division, division_name)"),
    # ---------------- raw procurement views -------------------------------
    ("src_notices", """
SELECT CAST(o_orderkey AS VARCHAR) AS notice_id,
  CASE o_orderstatus WHEN 'F' THEN 'CAN' WHEN 'O' THEN 'CN' ELSE 'PIN' END AS notice_type,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN 'Z' ELSE '+01:00' END
    AS publication_date,
  CAST(c_custkey AS VARCHAR) AS buyer_org_id,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS buyer_name,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END AS buyer_country,
  'contract ' || CAST(o_orderkey AS VARCHAR) AS project_title,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'works' WHEN 'MACHINERY' THEN 'supply' WHEN 'AUTOMOBILE' THEN 'SUPPLIES'
    WHEN 'HOUSEHOLD' THEN 'services' ELSE 'combined' END AS proc_type,
  o_orderpriority AS procedure_type,
  CAST(30 + c_custkey % 50 AS VARCHAR) || '000000' AS cpv_main,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 'n/a'
    ELSE CAST(o_totalprice AS VARCHAR) END AS est_amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""),
    ("src_lot_results", """
SELECT CAST(l_orderkey AS VARCHAR) AS notice_id, 'RES-' || CAST(l_linenumber AS VARCHAR) AS lot_result_id,
  'LOT-' || CAST(l_linenumber AS VARCHAR) AS lot_id,
  CASE l_returnflag WHEN 'R' THEN 'selec-w' WHEN 'A' THEN 'clos-nw' ELSE 'open-nw' END AS result_code,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) % 12 END AS tenders_count,
  CAST(l_suppkey AS VARCHAR) AS winner_org_id,
  l_extendedprice * (1 - l_discount) AS awarded_amount,
  CASE WHEN l_returnflag = 'R' THEN 'TEN-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) END AS winner_tender_id
FROM lineitem"""),
    ("src_contracts", """
SELECT CAST(l_orderkey AS VARCHAR) AS notice_id, 'RES-' || CAST(l_linenumber AS VARCHAR) AS lot_result_id,
  'CON-' || CAST(l_partkey AS VARCHAR) AS contract_id,
  CASE WHEN l_partkey % 97 = 0 THEN -l_extendedprice ELSE l_extendedprice * (1 - l_discount) END
    AS contract_value,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || 'Z' AS contract_date
FROM lineitem WHERE l_linestatus = 'F'"""),
    ("src_tenders", """
SELECT CAST(l_orderkey AS VARCHAR) AS notice_id,
  'TEN-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS tender_id,
  'LOT-' || CAST(l_linenumber % 2 AS VARCHAR) AS lot_id, CAST(l_suppkey AS VARCHAR) AS tendering_party_id,
  l_extendedprice / l_quantity AS tender_value,
  CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END AS is_ranked,
  l_linenumber AS rank, l_shipdate AS bid_date
FROM lineitem"""),
    ("src_organisations", """
SELECT CAST(o_orderkey AS VARCHAR) AS notice_id, CAST(c_custkey AS VARCHAR) AS org_id, c_name AS org_name,
  n_name AS org_country,
  CASE WHEN c_acctbal < 0 THEN 'micro' WHEN c_acctbal < 3000 THEN 'small' WHEN c_acctbal < 6000 THEN 'Medium'
    ELSE 'large' END AS sme, 0 AS source_order
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT DISTINCT CAST(l_orderkey AS VARCHAR), CAST(s_suppkey AS VARCHAR), s_name, n_name,
  CASE WHEN s_acctbal < 3000 THEN 'small' ELSE 'large' END, 1
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""),
    ("src_cpv_codes", """
SELECT CAST(l_orderkey AS VARCHAR) AS notice_id,
  CAST(30 + p_size AS VARCHAR) || CASE WHEN p_partkey % 50 = 0 THEN '00' ELSE '000000' END AS cpv_code
FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    ("src_lots", """
SELECT CAST(l_orderkey AS VARCHAR) AS notice_id, 'LOT-' || CAST(l_linenumber AS VARCHAR) AS lot_id,
  l_extendedprice AS lot_est, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_quantity END AS duration_val,
  l_shipdate AS lot_date, l_partkey AS source_order
FROM lineitem"""),
    ("src_tendering_parties", """
SELECT CAST(l_orderkey AS VARCHAR) AS notice_id, CAST(l_suppkey AS VARCHAR) AS party_id,
  string_agg('TEN-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR), ', '
    ORDER BY 'TEN-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)) AS tender_ids,
  count(*) AS num_tenders
FROM lineitem GROUP BY l_orderkey, l_suppkey"""),
    ("src_events", "SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events"),
    ("src_titles", """
SELECT d.doc_id, d.text AS project_title, d.lang AS cpv_division, l.quality AS quality_label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    # ---------------- silver ---------------------------------------------
    ("t_notices", """
SELECT notice_id, notice_type,
  substr(regexp_replace(regexp_replace(publication_date, '[+\\-]\\d{2}:\\d{2}$', ''), 'Z$', ''), 1, 10) AS pub_date,
  buyer_org_id, buyer_name, buyer_country, project_title,
  COALESCE(CASE lower(proc_type) WHEN 'services' THEN 'Services' WHEN 'supplies' THEN 'Supplies'
    WHEN 'works' THEN 'Works' WHEN 'service' THEN 'Services' WHEN 'supply' THEN 'Supplies' END, proc_type)
    AS proc_type,
  procedure_type, cpv_main, substr(cpv_main, 1, 2) AS cpv_division, k.division_name AS cpv_division_name,
  TRY_CAST(est_amount AS DOUBLE) AS estimated, TRY_CAST(est_amount AS DOUBLE) AS estimated_value,
  CAST(NULL AS VARCHAR) AS est_currency, CAST(NULL AS DOUBLE) AS total_awarded,
  CAST(NULL AS VARCHAR) AS submission_deadline, CAST(NULL AS VARCHAR) AS framework,
  CAST(NULL AS VARCHAR) AS source_file
FROM src_notices LEFT JOIN cpv_lookup k ON k.division = substr(cpv_main, 1, 2)"""),
    ("s_notices_raw", _dedupe("t_notices", ["notice_id"], _NOTICE_COLS)),
    ("t_organisations", f"""
SELECT *, COALESCE(lower(sme) IN ({_SME}), false) AS is_sme FROM src_organisations"""),
    ("s_organisations", _dedupe("t_organisations", ["notice_id", "org_id"], _ORG_COLS)),
    ("s_notices", """
SELECT n.notice_id, n.notice_type, n.pub_date, n.buyer_org_id, COALESCE(n.buyer_name, o.org_name) AS buyer_name,
  COALESCE(n.buyer_country, o.org_country) AS buyer_country, n.project_title, n.proc_type, n.procedure_type,
  n.cpv_main, n.cpv_division, n.cpv_division_name, n.estimated, n.estimated_value, n.est_currency,
  n.total_awarded, n.submission_deadline, n.framework, n.source_file
FROM s_notices_raw n LEFT JOIN s_organisations o
  ON n.notice_id = o.notice_id AND n.buyer_org_id IS NOT DISTINCT FROM o.org_id"""),
    ("t_lots", """
SELECT notice_id, lot_id, TRY_CAST(lot_est AS DOUBLE) AS lot_est, TRY_CAST(duration_val AS DOUBLE) AS duration_val,
  lot_date, source_order FROM src_lots"""),
    ("s_lots", _dedupe("t_lots", ["notice_id", "lot_id"], _LOT_COLS)),
    ("t_lot_results", """
SELECT notice_id, lot_result_id, lot_id, result_code, CAST(TRY_CAST(tenders_count AS DOUBLE) AS INTEGER) AS tenders_count,
  winner_org_id, TRY_CAST(awarded_amount AS DOUBLE) AS awarded_amount, winner_tender_id, CAST(NULL AS INTEGER) AS sme_tenders,
  CAST(NULL AS VARCHAR) AS award_currency,
  COALESCE(lower(result_code) = 'selec-w', false) AS is_awarded,
  CASE lower(result_code) WHEN 'selec-w' THEN 'Awarded' WHEN 'clos-nw' THEN 'Closed without winner'
    WHEN 'open-nw' THEN 'Open without winner' WHEN 'unpublished' THEN 'Unpublished' END AS result_status
FROM src_lot_results"""),
    ("s_lot_results", _dedupe("t_lot_results", ["notice_id", "lot_result_id"], _LR_COLS)),
    ("t_tenders", """
SELECT notice_id, tender_id, lot_id, tendering_party_id, TRY_CAST(tender_value AS DOUBLE) AS tender_value,
  is_ranked, rank, bid_date, TRY_CAST(tender_value AS DOUBLE) AS bid_amount, CAST(NULL AS VARCHAR) AS subcontracting,
  CAST(NULL AS VARCHAR) AS tender_currency, CAST(NULL AS DOUBLE) AS subcontracting_pct
FROM src_tenders"""),
    ("s_tenders", _dedupe("t_tenders", ["notice_id", "tender_id"], _TENDER_COLS)),
    ("t_contracts", """
SELECT notice_id, lot_result_id, contract_id,
  CASE WHEN TRY_CAST(contract_value AS DOUBLE) < 0 THEN NULL ELSE TRY_CAST(contract_value AS DOUBLE) END
    AS contract_value,
  substr(regexp_replace(regexp_replace(contract_date, '[+\\-]\\d{2}:\\d{2}$', ''), 'Z$', ''), 1, 10) AS contract_date,
  TRY_CAST(contract_value AS DOUBLE) AS contract_value_raw,
  COALESCE(TRY_CAST(contract_value AS DOUBLE) < 0, false) AS contract_value_was_negative_source
FROM src_contracts"""),
    ("s_contracts", _dedupe("t_contracts", ["notice_id", "lot_result_id", "contract_id"], _CONTRACT_COLS)),
    ("t_cpv_codes", """
SELECT notice_id, cpv_code, substr(cpv_code, 1, 2) AS cpv_division, k.division_name AS cpv_division_name
FROM src_cpv_codes LEFT JOIN cpv_lookup k ON k.division = substr(cpv_code, 1, 2)"""),
    ("s_cpv_codes", _dedupe("t_cpv_codes", ["notice_id", "cpv_code"], _CPV_COLS)),
    ("s_tendering_parties", """
SELECT notice_id, party_id, tender_ids, num_tenders, party_id AS tenderer_id FROM src_tendering_parties"""),
    # ---------------- gold ------------------------------------------------
    ("gold_notices", f"""
SELECT n.notice_id, n.notice_type, n.pub_date, n.submission_deadline, n.buyer_org_id, n.buyer_name,
  n.buyer_country, n.project_title, n.proc_type, n.procedure_type, n.cpv_main AS cpv_code, n.cpv_main,
  c.cpv_codes, n.cpv_division, n.cpv_division_name, n.estimated, n.total_awarded, l.lot_count,
  l.lot_estimated_total, l.avg_lot_duration, r.result_count, r.awarded_lot_count, r.awarded_amount,
  k.contract_count, k.contract_value, k.first_contract_date, t.tender_count, p.tendering_party_count,
  r.avg_tenders_count, t.tender_value, n.framework, n.source_file
FROM s_notices n
LEFT JOIN (SELECT notice_id, array_to_string(list_sort(list_distinct(list(cpv_code))), ', ') AS cpv_codes
           FROM s_cpv_codes WHERE cpv_code <> '' GROUP BY notice_id) c ON c.notice_id = n.notice_id
LEFT JOIN (SELECT notice_id, count(DISTINCT lot_id) AS lot_count, sum({_nn('lot_est')}) AS lot_estimated_total,
           avg({_nn('duration_val')}) AS avg_lot_duration FROM s_lots GROUP BY notice_id) l ON l.notice_id = n.notice_id
LEFT JOIN (SELECT notice_id, count(DISTINCT lot_result_id) AS result_count,
           count(*) FILTER (WHERE is_awarded) AS awarded_lot_count,
           sum({_nn('awarded_amount')}) AS awarded_amount, avg({_nn('tenders_count')}) AS avg_tenders_count
           FROM s_lot_results GROUP BY notice_id) r ON r.notice_id = n.notice_id
LEFT JOIN (SELECT notice_id, count(DISTINCT contract_id) AS contract_count,
           sum({_nn('contract_value')}) AS contract_value,
           min(CASE WHEN substr(contract_date, 1, 10) NOT IN ('', 'None', 'nan', 'NaT', '<NA>')
               THEN substr(contract_date, 1, 10) END) AS first_contract_date
           FROM s_contracts GROUP BY notice_id) k ON k.notice_id = n.notice_id
LEFT JOIN (SELECT notice_id, count(DISTINCT party_id) AS tendering_party_count FROM s_tendering_parties
           GROUP BY notice_id) p ON p.notice_id = n.notice_id
LEFT JOIN (SELECT notice_id, count(DISTINCT tender_id) AS tender_count, sum({_nn('tender_value')}) AS tender_value
           FROM s_tenders GROUP BY notice_id) t ON t.notice_id = n.notice_id"""),
    ("contract_by_result", f"""
SELECT notice_id, lot_result_id, sum({_nn('contract_value')}) AS contract_value,
  min(CASE WHEN substr(contract_date, 1, 10) NOT IN ('', 'None', 'nan', 'NaT', '<NA>')
      THEN substr(contract_date, 1, 10) END) AS contract_date,
  count(DISTINCT contract_id) AS contract_count
FROM s_contracts GROUP BY notice_id, lot_result_id"""),
    ("gold_lots", f"""
SELECT l.notice_id, l.lot_id, n.notice_type, n.pub_date, n.buyer_name, n.buyer_country, n.project_title,
  n.proc_type, n.procedure_type, n.cpv_main AS cpv_code, n.cpv_division, n.cpv_division_name, n.estimated,
  l.lot_est, l.duration_val, r.result_code, r.is_awarded, r.winner_org_id, r.tenders_count, r.awarded_amount,
  k.contract_value, k.contract_date, k.contract_count, t.tender_count, t.tender_value, t.avg_tender_value,
  r.lot_result_count
FROM s_lots l
LEFT JOIN (SELECT notice_id, lot_id,
           arg_min(result_code, lot_result_id) FILTER (WHERE result_code IS NOT NULL) AS result_code,
           bool_or(is_awarded) AS is_awarded,
           arg_min(winner_org_id, lot_result_id) FILTER (WHERE winner_org_id IS NOT NULL) AS winner_org_id,
           avg({_nn('tenders_count')}) AS tenders_count, sum({_nn('awarded_amount')}) AS awarded_amount,
           count(DISTINCT lot_result_id) AS lot_result_count
           FROM s_lot_results GROUP BY notice_id, lot_id) r ON r.notice_id = l.notice_id AND r.lot_id = l.lot_id
LEFT JOIN (SELECT c.notice_id, b.lot_id, sum({_nn('c.contract_value')}) AS contract_value,
           min(CASE WHEN substr(c.contract_date, 1, 10) NOT IN ('', 'None', 'nan', 'NaT', '<NA>')
               THEN substr(c.contract_date, 1, 10) END) AS contract_date,
           count(DISTINCT c.contract_id) AS contract_count
           FROM s_contracts c LEFT JOIN (SELECT DISTINCT notice_id, lot_result_id, lot_id FROM s_lot_results) b
             ON b.notice_id = c.notice_id AND b.lot_result_id = c.lot_result_id
           WHERE b.lot_id IS NOT NULL GROUP BY c.notice_id, b.lot_id) k
  ON k.notice_id = l.notice_id AND k.lot_id = l.lot_id
LEFT JOIN (SELECT notice_id, lot_id, count(DISTINCT tender_id) AS tender_count,
           sum({_nn('tender_value')}) AS tender_value, avg({_nn('tender_value')}) AS avg_tender_value
           FROM s_tenders GROUP BY notice_id, lot_id) t ON t.notice_id = l.notice_id AND t.lot_id = l.lot_id
LEFT JOIN s_notices n ON n.notice_id = l.notice_id"""),
    ("best_tender", f"""
SELECT notice_id, lot_id, tender_id AS winner_tender_id, {_nn('tender_value')} AS tender_value, tender_currency
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY notice_id, lot_id
        ORDER BY TRY_CAST(rank AS DOUBLE) ASC NULLS LAST, tender_id) AS _rn
      FROM s_tenders WHERE lower(CAST(is_ranked AS VARCHAR)) = 'true') WHERE _rn = 1"""),
    ("gold_awards", f"""
SELECT a.notice_id, a.lot_id, a.lot_result_id, n.notice_type, n.pub_date, n.buyer_name, n.buyer_country,
  n.project_title, n.proc_type, n.procedure_type, n.cpv_main AS cpv_code, n.cpv_division, n.cpv_division_name,
  a.result_code, a.is_awarded, a.winner_org_id, o.org_name AS winner_name, o.org_country AS winner_country,
  o.is_sme, a.tenders_count, a.sme_tenders, {_nn('a.awarded_amount')} AS awarded_amount, a.award_currency,
  k.contract_value, k.contract_date, k.contract_count, w.tender_value, w.tender_currency, n.estimated,
  n.total_awarded, l.lot_est
FROM (SELECT * FROM s_lot_results WHERE is_awarded) a
LEFT JOIN contract_by_result k ON k.notice_id = a.notice_id AND k.lot_result_id = a.lot_result_id
LEFT JOIN s_lots l ON l.notice_id = a.notice_id AND l.lot_id = a.lot_id
LEFT JOIN best_tender w ON w.notice_id = a.notice_id AND w.lot_id = a.lot_id
LEFT JOIN s_organisations o ON o.notice_id = a.notice_id AND o.org_id = a.winner_org_id
LEFT JOIN s_notices n ON n.notice_id = a.notice_id"""),
    ("gold_opportunities", """
SELECT n.notice_id, n.pub_date, n.buyer_name, n.buyer_country, n.buyer_org_id, n.project_title, n.proc_type,
  n.procedure_type, n.cpv_main, n.cpv_division, n.cpv_division_name,
  COALESCE(n.estimated, l.total_est_lots) AS estimated, l.num_lots, l.avg_lot_duration, n.submission_deadline,
  n.framework, n.source_file
FROM s_notices n
LEFT JOIN (SELECT notice_id, count(lot_id) AS num_lots, COALESCE(sum(lot_est), 0) AS total_est_lots,
           avg(duration_val) AS avg_lot_duration FROM s_lots GROUP BY notice_id) l ON l.notice_id = n.notice_id
WHERE n.notice_type = 'CN'"""),
    ("gold_notice_awards", """
SELECT notice_id, pub_date, buyer_name, buyer_country, buyer_org_id, project_title, proc_type, cpv_main,
  cpv_division, cpv_division_name, estimated, awarded_eur,
  CASE WHEN estimated > 0 THEN round_even((estimated - awarded_eur) / estimated * 100, 1) END AS savings_pct,
  num_lots, num_awarded_lots, avg_tenders_per_lot, total_tenders, winner_names, winner_countries, sme_winner,
  avg_lot_duration, source_file
FROM (
  SELECT n.*, COALESCE(n.estimated, lo.total_est_lots) AS estimated_f,
    COALESCE(n.total_awarded, r.lr_total_awarded) AS awarded_eur, r.num_lots, r.num_awarded_lots,
    r.avg_tenders_per_lot, r.total_tenders, w.winner_names, w.winner_countries, w.sme_winner, lo.avg_lot_duration
  FROM s_notices n
  LEFT JOIN (SELECT notice_id, count(lot_id) AS num_lots, COALESCE(sum(awarded_amount), 0) AS lr_total_awarded,
             avg(tenders_count) AS avg_tenders_per_lot, CAST(COALESCE(sum(tenders_count), 0) AS BIGINT) AS total_tenders,
             count(*) FILTER (WHERE is_awarded) AS num_awarded_lots
             FROM s_lot_results GROUP BY notice_id) r ON r.notice_id = n.notice_id
  LEFT JOIN (SELECT a.notice_id,
               COALESCE(array_to_string(list_sort(list_distinct(list(o.org_name) FILTER (WHERE o.org_name <> ''))), ', '), '')
                 AS winner_names,
               COALESCE(array_to_string(list_sort(list_distinct(list(o.org_country) FILTER (WHERE o.org_country <> ''))), ', '), '')
                 AS winner_countries,
               COALESCE(bool_or(o.is_sme), false) AS sme_winner
             FROM (SELECT notice_id, winner_org_id FROM s_lot_results WHERE is_awarded) a
             LEFT JOIN s_organisations o ON o.notice_id = a.notice_id AND o.org_id = a.winner_org_id
             GROUP BY a.notice_id) w ON w.notice_id = n.notice_id
  LEFT JOIN (SELECT notice_id, avg(duration_val) AS avg_lot_duration, sum(lot_est) AS total_est_lots
             FROM s_lots GROUP BY notice_id) lo ON lo.notice_id = n.notice_id
  WHERE n.notice_type = 'CAN'
) x(notice_id, notice_type, pub_date, buyer_org_id, buyer_name, buyer_country, project_title, proc_type,
    procedure_type, cpv_main, cpv_division, cpv_division_name, estimated_orig, estimated_value, est_currency,
    total_awarded, submission_deadline, framework, source_file, estimated, awarded_eur, num_lots,
    num_awarded_lots, avg_tenders_per_lot, total_tenders, winner_names, winner_countries, sme_winner,
    avg_lot_duration)"""),
]


def with_base(body: str) -> str:
    """Prefix the shared CTEs to an oracle body (which may have its own WITH)."""
    ctes = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in BASE_CTES)
    b = body.strip()
    if b[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{b[5:]}"
    return f"WITH {ctes}\n{b}"


def add_ctes(extra: list[tuple[str, str]]) -> None:
    """Append analytics-level shared CTEs (e.g. notice_awards)."""
    names = {n for n, _ in BASE_CTES}
    for name, sql in extra:
        if name not in names:
            BASE_CTES.append((name, sql))


SILVER_COLUMNS = {
    "notices": _NOTICE_COLS, "lots": _LOT_COLS, "organisations": _ORG_COLS, "cpv_codes": _CPV_COLS,
    "lot_results": _LR_COLS, "contracts": _CONTRACT_COLS,
    "tendering_parties": ["notice_id", "party_id", "tender_ids", "num_tenders", "tenderer_id"],
    "tenders": _TENDER_COLS,
}
