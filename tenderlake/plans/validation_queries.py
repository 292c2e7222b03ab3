"""Silver validation suite and gold smoke checks (O-VLD-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.lookups import (CRITICAL_COLUMNS, EXPECTED_SCHEMAS, IMPORTANT_ML_FIELDS, NATURAL_KEYS,
                                 OPTIONAL_COLUMNS, RESULT_STATUSES)
from ..operators import validate as V
from ..registry import query
from ..sources.tables import TABLES
from . import common as K

SILVER = ["notices", "lots", "organisations", "cpv_codes", "lot_results", "contracts", "tendering_parties", "tenders"]
S = {t: f"s_{t}" for t in SILVER}


def _tables(lake):
    """The silver tables; their counters are worked out once for a lake."""
    return V.Tables({t: lake.silver(t) for t in SILVER}, lambda name, build: lake.derived(name, build, persist=True))


def _st(bad: str, warn: str | None = None) -> str:
    w = f" WHEN {warn} THEN 'WARN'" if warn else ""
    return f"CASE WHEN {bad} = 0 THEN 'PASS'{w} ELSE 'FAIL' END"


def _row(table: str, check: str, bad_sql: str, mode: str = "fail") -> str:
    st = f"CASE WHEN b = 0 THEN 'PASS' ELSE '{'WARN' if mode == 'warn' else 'FAIL'}' END"
    return f"SELECT {st} AS status, '{table}' AS table_name, '{check}' AS check_name, CAST(b AS BIGINT) AS bad_rows " \
           f"FROM ({bad_sql}) x(b)"


PK_SQL = "\nUNION ALL\n".join(
    f"SELECT {_st('b')} AS status, '{t}' AS table_name, 'primary key' AS check_name, CAST(b AS BIGINT) AS bad_rows "
    f"FROM (SELECT COALESCE(sum(CASE WHEN n > 1 THEN n ELSE 0 END), 0) + COALESCE(sum(CASE WHEN nk THEN n ELSE 0 END), 0) "
    f"AS b FROM (SELECT count(*) AS n, bool_or({' OR '.join(f'{k} IS NULL' for k in keys)}) AS nk FROM {S[t]} "
    f"GROUP BY {', '.join(keys)}))" for t, keys in NATURAL_KEYS.items())


@query("check_primary_key", sql=PK_SQL)
def check_primary_key(lake):
    """Natural key uniqueness (duplicate rows, keep=False) and NULL key parts per table."""
    return V.check_primary_key(_tables(lake))


COMPLETENESS_SQL = "\nUNION ALL\n".join(
    [f"SELECT {_st('b', 'b * 1.0 / n < 0.01')} AS status, '{t}' AS table_name, "
     f"'critical completeness: {c}' AS check_name, CAST(b AS BIGINT) AS bad_rows "
     f"FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) AS b, count(*) AS n FROM {S[t]})"
     for t, cols in CRITICAL_COLUMNS.items() for c in cols]
    + [_row("notices", "pub_date parsed", "SELECT count(*) FILTER (WHERE TRY_CAST(pub_date AS DATE) IS NULL) FROM s_notices")])


@query("check_completeness", sql=COMPLETENESS_SQL)
def check_completeness(lake):
    """Critical-column completeness (0 -> PASS, < 1 % -> WARN, else FAIL) and parsed publication dates."""
    return V.check_completeness(_tables(lake))


NOTICE_REF_SQL = ("\nUNION ALL\n".join(
    f"SELECT {_st('b')} AS status, '{t}' AS table_name, 'notice_id reference' AS check_name, CAST(b AS BIGINT) AS bad_rows "
    f"FROM (SELECT count(*) AS b FROM {S[t]} c WHERE c.notice_id IS NULL OR NOT EXISTS "
    f"(SELECT 1 FROM s_notices n WHERE n.notice_id = c.notice_id))" for t in SILVER if t != "notices"))


@query("check_notice_ref", sql=NOTICE_REF_SQL)
def check_notice_ref(lake):
    """Every child row's notice_id exists in notices."""
    return V.check_notice_ref({t: lake.silver_keys(t) for t in SILVER})  # it reads nothing but ids, once for each row


def _ref_sql(child, ck, parent, pk, name, warn_max):
    cond = " AND ".join(f"CAST(p.{b} AS VARCHAR) = CAST(c.{a} AS VARCHAR)" for a, b in zip(ck, pk))
    notnull = " AND ".join(f"c.{a} IS NOT NULL" for a in ck)
    warn = f"b <= {warn_max}" if warn_max is not None else None
    return (f"SELECT {_st('b', warn)} AS status, '{child}' AS table_name, '{name}' AS check_name, "
            f"CAST(b AS BIGINT) AS bad_rows FROM (SELECT count(*) AS b FROM {S[child]} c WHERE {notnull} AND NOT EXISTS "
            f"(SELECT 1 FROM {S[parent]} p WHERE {cond}))")


REFS_SQL = ("\nUNION ALL\n".join(_ref_sql(*r) for r in V.REFS))


@query("check_refs", sql=REFS_SQL)
def check_refs(lake):
    """Composite reference checks (buyer org, result->lot, tender->lot / party, winner->tender, contract->result)."""
    return V.check_refs(_tables(lake))


IDS_SQL = """ids AS (SELECT notice_id, trim(t.tid) AS tender_id
  FROM s_tendering_parties, unnest(string_split(tender_ids, ',')) AS t(tid)
  WHERE notice_id IS NOT NULL AND tender_ids IS NOT NULL AND trim(t.tid) <> '')"""


LIST_REF_SQL = (f"""WITH {IDS_SQL}
SELECT {_st('b')} AS status, 'tendering_parties' AS table_name, 'tender_ids reference' AS check_name,
  CAST(b AS BIGINT) AS bad_rows
FROM (SELECT count(*) AS b FROM ids WHERE NOT EXISTS
      (SELECT 1 FROM s_tenders t WHERE t.notice_id = ids.notice_id AND t.tender_id = ids.tender_id))""")


@query("check_list_ref", sql=LIST_REF_SQL)
def check_list_ref(lake):
    """Each id in the comma-joined tender list must exist as a tender of the notice."""
    return V.check_list_ref(_tables(lake))


FORMAT_SQL = ("\nUNION ALL\n".join([
    _row("notices", "cpv_main format",
         "SELECT count(*) FILTER (WHERE cpv_main IS NOT NULL AND NOT regexp_full_match(cpv_main, '\\d{8}')) FROM s_notices"),
    _row("cpv_codes", "cpv_code format",
         "SELECT count(*) FILTER (WHERE cpv_code IS NOT NULL AND NOT regexp_full_match(cpv_code, '\\d{8}')) FROM s_cpv_codes"),
    _row("organisations", "org_country format",
         "SELECT count(*) FILTER (WHERE org_country IS NOT NULL AND NOT regexp_full_match(org_country, '[A-Z]{3}')) "
         "FROM s_organisations", "warn")]))


@query("check_format", sql=FORMAT_SQL)
def check_format(lake):
    """Format rules: CPV codes are 8 digits, countries 3 upper-case letters."""
    return V.check_format(_tables(lake))


_STATUS_CASE = "CASE lower(result_code) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in RESULT_STATUSES.items()) + " ELSE 'Unknown' END"


DERIVED_SQL = ("\nUNION ALL\n".join([
    _row("notices", "cpv_division derivation",
         "SELECT count(*) FILTER (WHERE cpv_main IS NOT NULL AND cpv_division IS NOT NULL "
         "AND substr(cpv_main, 1, 2) <> cpv_division) FROM s_notices"),
    _row("lot_results", "is_awarded mapping",
         "SELECT count(*) FILTER (WHERE is_awarded IS DISTINCT FROM COALESCE(lower(result_code) = 'selec-w', false)) "
         "FROM s_lot_results"),
    _row("lot_results", "result_status mapping",
         f"SELECT count(*) FILTER (WHERE COALESCE(result_status, 'None') IS DISTINCT FROM ({_STATUS_CASE})) "
         "FROM s_lot_results")]))


@query("check_derived", sql=DERIVED_SQL)
def check_derived(lake):
    """Derived columns agree with their sources (CPV division, awarded flag, status label)."""
    return V.check_derived(_tables(lake))


DOMAIN_SQL = ("\nUNION ALL\n".join([
    _row("lot_results", "result_code domain",
         "SELECT count(*) FILTER (WHERE result_code IS NOT NULL AND lower(result_code) NOT IN ("
         + ", ".join(f"'{k}'" for k in RESULT_STATUSES) + ")) FROM s_lot_results", "warn"),
    _row("lot_results", "result_status domain",
         "SELECT count(*) FILTER (WHERE result_status IS NOT NULL AND result_status NOT IN ("
         + ", ".join(f"'{v}'" for v in RESULT_STATUSES.values()) + ")) FROM s_lot_results", "warn")]))


@query("check_domain", sql=DOMAIN_SQL)
def check_domain(lake):
    """Result codes and status labels belong to their domains."""
    return V.check_domain(_tables(lake))


def _below_sql(c, m):
    return (f"count(*) FILTER (WHERE ({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) "
            f"OR TRY_CAST({c} AS DOUBLE) < {m})")


FLOOR_SQL = ("\nUNION ALL\n".join([
    _row("contracts", "contract_value non-negative", f"SELECT {_below_sql('contract_value', 0)} FROM s_contracts"),
    _row("tendering_parties", "num_tenders non-negative",
         f"SELECT {_below_sql('num_tenders', 0)} FROM s_tendering_parties"),
    _row("tenders", "tender_value non-negative", f"SELECT {_below_sql('tender_value', 0)} FROM s_tenders", "warn"),
    _row("tenders", "rank domain", f"SELECT {_below_sql('rank', 1)} FROM s_tenders", "warn")]))


@query("check_floor", sql=FLOOR_SQL)
def check_floor(lake):
    """Numeric floors: non-numeric or below the minimum."""
    return V.check_floor(_tables(lake))


LIST_COUNT_SQL = (_row("tendering_parties", "tender_ids count", """
SELECT count(*) FILTER (WHERE TRY_CAST(num_tenders AS DOUBLE) IS NOT NULL AND
  (SELECT count(*) FROM unnest(string_split(tender_ids, ',')) AS u(x) WHERE trim(u.x) <> '')
    <> TRY_CAST(num_tenders AS DOUBLE))
FROM s_tendering_parties WHERE tender_ids IS NOT NULL"""))


@query("check_list_count", sql=LIST_COUNT_SQL)
def check_list_count(lake):
    """num_tenders equals the number of ids in the tender list."""
    return V.check_list_count(_tables(lake))


ALL_CHECK_KEYS = ["check_primary_key", "check_completeness", "check_notice_ref", "check_refs", "check_list_ref",
                  "check_format", "check_derived", "check_domain", "check_floor", "check_list_count"]


def _strip_ids(sql: str) -> str:
    body = sql.strip()
    prefix = f"WITH {IDS_SQL}"
    return body[len(prefix):].strip() if body.startswith(prefix) else body


def _summary_sql() -> str:
    bodies = [PK_SQL, COMPLETENESS_SQL, NOTICE_REF_SQL, REFS_SQL, _strip_ids(LIST_REF_SQL), FORMAT_SQL, DERIVED_SQL,
              DOMAIN_SQL, FLOOR_SQL, LIST_COUNT_SQL]
    union = "\nUNION ALL\n".join(f"SELECT status FROM ({b})" for b in bodies)
    return f"WITH {IDS_SQL}\nSELECT status, count(*) AS n_checks FROM ({union}) GROUP BY status"


@query("check_summary", sql=_summary_sql())
def check_summary(lake):
    """Check counts by status over the whole suite (any FAIL fails a run)."""
    return V.all_checks(_tables(lake)).groupBy("status").agg(F.count(F.lit(1)).alias("n_checks"))


def _profile_sql() -> str:
    from .oracle_base import SILVER_COLUMNS
    parts = []
    for t in SILVER:
        cols = SILVER_COLUMNS[t]
        agg = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)
        for c in cols:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, n_rows, {c} AS null_count, "
                         f"{c} * 100.0 / n_rows AS null_pct FROM (SELECT count(*) AS n_rows, {agg} FROM {S[t]})")
    return "\nUNION ALL\n".join(parts)


@query("profile_columns", sql=_profile_sql())
def profile_columns(lake):
    """Rows and per-column null count / % of every silver table (one pass per table)."""
    out = []
    for t in SILVER:
        df = lake.silver(t)
        agg = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        long = agg.unpivot("n_rows", df.columns, "column_name", "null_count")
        out.append(long.select(F.lit(t).alias("table_name"), "column_name", "n_rows", "null_count",
                               (F.col("null_count") * 100.0 / F.col("n_rows")).alias("null_pct")))
    return reduce(lambda a, b: a.unionByName(b), out)


def _coverage_status(n, rows):
    return F.when(n == 0, "EMPTY").when(n * 1.0 / rows < 0.5, "LOW").otherwise("ok")


@query("field_coverage", sql="\nUNION ALL\n".join(
    f"SELECT '{f}' AS field, '{t}' AS table_name, '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows, "
    f"count({c}) * 100.0 / count(*) AS pct, CASE WHEN count({c}) = 0 THEN 'EMPTY' "
    f"WHEN count({c}) * 1.0 / count(*) < 0.5 THEN 'LOW' ELSE 'ok' END AS coverage FROM {S[t]}"
    for f, t, c in IMPORTANT_ML_FIELDS))
def field_coverage(lake):
    """Coverage of the fields the models need: EMPTY / LOW (< 50 %) / ok."""
    out = []
    for f, t, c in IMPORTANT_ML_FIELDS:
        agg = lake.silver(t).agg(F.count(c).alias("non_null"), F.count(F.lit(1)).alias("n_rows"))
        out.append(agg.select(F.lit(f).alias("field"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                              "non_null", "n_rows", (F.col("non_null") * 100.0 / F.col("n_rows")).alias("pct"),
                              _coverage_status(F.col("non_null"), F.col("n_rows")).alias("coverage")))
    return reduce(lambda a, b: a.unionByName(b), out)


# FIXED VALUES: the profiled (table, column) pairs.
PROFILES = [("notices", "notice_type"), ("notices", "proc_type"), ("notices", "buyer_country"),
            ("notices", "cpv_division_name"), ("lot_results", "result_status"), ("organisations", "sme"),
            ("tenders", "is_ranked"), ("tenders", "subcontracting")]


@query("value_profile", sql="SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), '<null>') AS value, "
    f"count(*) AS n FROM {S[t]} GROUP BY {c}" for t, c in PROFILES)
    + ") QUALIFY row_number() OVER (PARTITION BY table_name, column_name ORDER BY n DESC, value) <= 10")
def value_profile(lake):
    """Top-10 values (NULL shown as '<null>') of the profiled columns."""
    out = []
    for t, c in PROFILES:
        g = lake.silver(t).groupBy(F.col(c).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        out.append(g.select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                            F.coalesce("v", F.lit("<null>")).alias("value"), "n"))
    u = reduce(lambda a, b: a.unionByName(b), out)
    from pyspark.sql import Window as W
    # one row per distinct value of a low-cardinality profiled column
    w = W.partitionBy("table_name", "column_name").orderBy(F.col("n").desc(), "value")
    return u.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 10).drop("_r")


DATE_COLS = [("notices", "pub_date"), ("notices", "submission_deadline"), ("contracts", "contract_date")]


@query("date_ranges", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(TRY_CAST({c} AS DATE)) AS non_null, "
    f"min(TRY_CAST({c} AS DATE)) AS min_date, max(TRY_CAST({c} AS DATE)) AS max_date FROM {S[t]}" for t, c in DATE_COLS))
def date_ranges(lake):
    """Parsed date coverage and range of the date columns."""
    out = []
    for t, c in DATE_COLS:
        d = F.try_to_date(F.col(c).cast("string"))
        out.append(lake.silver(t).agg(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"),
                                      F.count(d).alias("non_null"), F.min(d).alias("min_date"),
                                      F.max(d).alias("max_date")))
    return reduce(lambda a, b: a.unionByName(b), out)


_TABLES_SQL = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)


@query("check_tables", sql=f"SELECT table_name, n_rows, CASE WHEN n_rows > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({_TABLES_SQL})")
def check_tables(lake):
    """Input tables: present, readable and with rows; a table that is missing fails with NULL rows."""
    from pyspark.errors import AnalysisException
    parts = []
    for t in TABLES:
        try:
            rows = lake.table(t).agg(F.count(F.lit(1)).alias("n_rows"))
        except AnalysisException:  # no such path
            rows = lake.spark.range(1).select(F.lit(None).cast("bigint").alias("n_rows"))
        parts.append(rows.select(F.lit(t).alias("table_name"), "n_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn(
        "status", F.when(F.col("n_rows") > 0, "PASS").otherwise("FAIL"))


class ChecksFailed(Exception):
    """At least one check of a strict run has the status FAIL."""


def run_checks(lake, strict: bool = False):
    """All checks (tables, then the silver suite) as one frame of (suite, status, n_checks), written; with
    ``strict`` a FAIL among them raises, so that the job that runs them fails."""
    tables = check_tables(lake).groupBy("status").agg(F.count(F.lit(1)).alias("n_checks")).select(F.lit("tables").alias("suite"), "*")
    silver = check_summary(lake).select(F.lit("silver").alias("suite"), "status", "n_checks")
    out = K.checkpointed(lake.spark, tables.unionByName(silver))
    failed = out.where(F.col("status") == "FAIL").collect()  # two rows at most
    if strict and failed:
        raise ChecksFailed(", ".join(f"{r.suite}: {r.n_checks} failed" for r in failed))
    return out


@query("check_schema")
def check_schema(lake):
    """Schema drift per silver table: missing / unexpected / optional-present columns, with the table's rows."""
    rows = []
    for t in SILVER:
        have = lake.silver(t).columns
        exp, opt = EXPECTED_SCHEMAS[t], OPTIONAL_COLUMNS.get(t, [])
        rows += [(t, "missing", c, "WARN") for c in exp if c not in have]
        rows += [(t, "unexpected", c, "WARN") for c in have if c not in exp and c not in opt]
        rows += [(t, "optional", c, "PASS") for c in opt if c in have]
    drift = lake.spark.createDataFrame(rows, "table_name string, kind string, column_name string, status string")
    counts = reduce(lambda a, b: a.unionByName(b), [
        lake.silver(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in SILVER])
    return counts.join(drift, "table_name", "left")


GOLD_KEYS = {"gold_notices": ["notice_id"], "gold_lots": ["notice_id", "lot_id"],
             "gold_awards": ["notice_id", "lot_result_id"], "gold_country_kpis": ["buyer_country"],
             "gold_cpv_kpis": ["cpv_division", "cpv_division_name"]}
NON_NEG = [("gold_awards", "awarded_amount"), ("gold_awards", "contract_value"), ("gold_awards", "tender_value"),
           ("gold_lots", "contract_value"), ("gold_lots", "tender_value")]


@query("gold_smoke", sql="\nUNION ALL\n".join(
    [f"SELECT CASE WHEN b > 0 THEN 'PASS' ELSE 'WARN' END AS status, '{g}' AS table_name, 'row count' AS check_name, "
     f"CAST(b AS BIGINT) AS value FROM (SELECT count(*) AS b FROM {g})" for g in GOLD_KEYS]
    + [f"SELECT {_st('b')}, '{g}', 'natural key uniqueness', CAST(b AS BIGINT) FROM (SELECT COALESCE(sum(n), 0) AS b "
       f"FROM (SELECT count(*) AS n FROM {g} GROUP BY {', '.join(k)} HAVING count(*) > 1))" for g, k in GOLD_KEYS.items()]
    + [f"SELECT {_st('b')}, 'gold_awards', 'awarded rows only', CAST(b AS BIGINT) FROM "
       f"(SELECT count(*) FILTER (WHERE is_awarded IS DISTINCT FROM true) AS b FROM gold_awards)"]
    + [f"SELECT CASE WHEN b = 0 THEN 'PASS' ELSE 'WARN' END, '{g}', '{c} non-negative', CAST(b AS BIGINT) FROM "
       f"(SELECT count(*) FILTER (WHERE {c} < 0) AS b FROM {g})" for g, c in NON_NEG]))
def gold_smoke(lake):
    """Gold smoke checks: row counts, key uniqueness, awarded-only, non-negative values."""
    out = []
    for g in GOLD_KEYS:
        out.append(lake.gold(g).agg(F.count(F.lit(1)).alias("b")).select(
            F.when(F.col("b") > 0, "PASS").otherwise("WARN").alias("status"), F.lit(g).alias("table_name"),
            F.lit("row count").alias("check_name"), F.col("b").cast("bigint").alias("value")))
    for g, k in GOLD_KEYS.items():
        d = lake.gold(g).groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        out.append(d.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("b")).select(
            V.status(F.col("b")).alias("status"), F.lit(g).alias("table_name"),
            F.lit("natural key uniqueness").alias("check_name"), F.col("b").cast("bigint").alias("value")))
    aw = lake.gold("gold_awards")
    out.append(aw.agg(F.count_if(~F.col("is_awarded").eqNullSafe(F.lit(True))).alias("b")).select(
        V.status(F.col("b")).alias("status"), F.lit("gold_awards").alias("table_name"),
        F.lit("awarded rows only").alias("check_name"), F.col("b").cast("bigint").alias("value")))
    for g, c in NON_NEG:
        out.append(lake.gold(g).agg(F.count_if(F.col(c) < 0).alias("b")).select(
            F.when(F.col("b") == 0, "PASS").otherwise("WARN").alias("status"), F.lit(g).alias("table_name"),
            F.lit(f"{c} non-negative").alias("check_name"), F.col("b").cast("bigint").alias("value")))
    return reduce(lambda a, b: a.unionByName(b), out)
