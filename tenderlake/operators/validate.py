"""Data-quality checks over the silver tables.

Every check yields rows ``(status, table_name, check_name, bad_rows)``.
Counters of one table come from a single aggregate over it, which all checks of a lake share
(written as one row), and are unpivoted; primary keys are one aggregate by key; reference checks are
multi-column ``left_anti`` joins on bare keys (rows with a NULL key part are skipped, as the surveyed checks drop them first).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.lookups import AWARDED_CODE, CRITICAL_COLUMNS, NATURAL_KEYS, RESULT_STATUSES

CHECK_COLS = ["status", "table_name", "check_name", "bad_rows"]


def status(bad: Column, warn: Column | None = None) -> Column:
    """PASS when no bad rows, else WARN when ``warn`` holds, else FAIL."""
    out = F.when(bad == 0, "PASS")
    if warn is not None:
        out = out.when(warn, "WARN")
    return out.otherwise("FAIL")


def _rows(agg: DataFrame, table: str, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate of counters into check rows.

    ``specs``: (counter column, check name, mode) with mode 'fail' | 'warn'.
    """
    parts = []
    for colname, check, mode in specs:
        bad = F.col(colname)
        parts.append(F.struct(F.when(bad == 0, "PASS").otherwise("WARN" if mode == "warn" else "FAIL").alias("status"),
                              F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                              bad.cast("bigint").alias("bad_rows")))
    return agg.select(F.explode(F.array(*parts)).alias("c")).select("c.*")


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _below(c: str, minimum: float) -> Column:
    v = F.col(c).try_cast("double")
    return F.count_if((F.col(c).isNotNull() & v.isNull()) | (v < minimum))


def _bad_rx(c: str, rx: str) -> Column:
    return F.count_if(F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(rx))


def _counter_specs() -> dict[str, list[tuple[str, Column]]]:
    """Every per-row counter of every silver table, so each table is scanned by
    exactly one aggregate; the checks below select their rows from it."""
    expected_status = F.coalesce(C.result_status("result_code"), F.lit("Unknown"))
    codes, labels = list(RESULT_STATUSES), list(RESULT_STATUSES.values())
    n_ids = F.size(F.filter(F.split("tender_ids", ","), lambda x: F.trim(x) != ""))
    exp = F.col("num_tenders").try_cast("double")
    specs: dict[str, list[tuple[str, Column]]] = {
        t: [(f"null:{c}", F.count_if(F.col(c).isNull())) for c in cols] for t, cols in CRITICAL_COLUMNS.items()}
    specs["notices"] += [
        ("pub_date_parsed", F.count_if(F.try_to_date("pub_date").isNull())),
        ("fmt:cpv_main", _bad_rx("cpv_main", r"^\d{8}$")),
        ("derived:cpv_division", F.count_if(F.col("cpv_main").isNotNull() & F.col("cpv_division").isNotNull()
                                            & (F.substring("cpv_main", 1, 2) != F.col("cpv_division"))))]
    specs["cpv_codes"] += [("fmt:cpv_code", _bad_rx("cpv_code", r"^\d{8}$"))]
    specs["organisations"] += [("fmt:org_country", _bad_rx("org_country", r"^[A-Z]{3}$"))]
    specs["lot_results"] += [
        ("derived:is_awarded", F.count_if(~F.col("is_awarded").eqNullSafe(
            F.coalesce(F.lower("result_code") == AWARDED_CODE, F.lit(False))))),
        ("derived:result_status", F.count_if(~F.coalesce(F.col("result_status"), F.lit("None"))
                                             .eqNullSafe(expected_status))),
        ("domain:result_code", F.count_if(F.col("result_code").isNotNull() & ~F.lower("result_code").isin(*codes))),
        ("domain:result_status", F.count_if(F.col("result_status").isNotNull()
                                            & ~F.col("result_status").isin(*labels)))]
    specs["contracts"] += [("floor:contract_value", _below("contract_value", 0))]
    specs["tendering_parties"] += [
        ("floor:num_tenders", _below("num_tenders", 0)),
        ("list_count", F.count_if(F.col("tender_ids").isNotNull() & exp.isNotNull() & (n_ids != exp)))]
    specs["tenders"] += [("floor:tender_value", _below("tender_value", 0)), ("floor:rank", _below("rank", 1))]
    return specs


class Tables(dict):
    """Tables by name; ``keep(name, build)`` may hold on to their counters between checks."""

    def __init__(self, tables: dict[str, DataFrame], keep=None):
        super().__init__(tables)
        self.keep = keep or (lambda name, build: build())


def table_counters(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """One single-pass aggregate per table holding all its counters (row count in ``_n``)."""
    def counters(t: str, spec: list[tuple[str, Column]]) -> DataFrame:
        return tables[t].agg(F.count(F.lit(1)).alias("_n"), *[e.alias(name) for name, e in spec])

    keep = tables.keep if isinstance(tables, Tables) else (lambda name, build: build())
    return {t: keep(f"counters.{t}", lambda t=t, spec=spec: counters(t, spec)) for t, spec in _counter_specs().items()}


def _from_counters(counters: dict[str, DataFrame], rows: list[tuple[str, str, str, str]]) -> DataFrame:
    """rows: (table, counter, check name, mode 'fail' | 'warn')."""
    by_table: dict[str, list] = {}
    for t, cname, check, mode in rows:
        by_table.setdefault(t, []).append((cname, check, mode))
    parts = []
    for t, specs in by_table.items():
        agg = counters[t].select(*[F.col(f"`{c}`").alias(f"c{i}") for i, (c, _, _) in enumerate(specs)])
        parts.append(_rows(agg, t, [(f"c{i}", check, mode) for i, (_, check, mode) in enumerate(specs)]))
    return union_all(parts)


def check_primary_key(tables: dict[str, DataFrame]) -> DataFrame:
    out = []
    for t, keys in NATURAL_KEYS.items():
        df = tables[t]
        g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                  F.max(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).alias("nk"))
        agg = g.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("dup"),
                    F.coalesce(F.sum(F.when(F.col("nk"), F.col("n"))), F.lit(0)).alias("nullk"))
        out.append(agg.select(status(F.col("dup") + F.col("nullk")).alias("status"), F.lit(t).alias("table_name"),
                              F.lit("primary key").alias("check_name"),
                              (F.col("dup") + F.col("nullk")).cast("bigint").alias("bad_rows")))
    return union_all(out)


def check_completeness(tables: dict[str, DataFrame]) -> DataFrame:
    """Critical columns: 0 nulls PASS, < 1 % WARN, else FAIL; plus pub_date parsed."""
    counters = table_counters(tables)
    out = []
    for t, cols in CRITICAL_COLUMNS.items():
        agg = counters[t].select("_n", *[F.col(f"`null:{c}`").alias(c) for c in cols])
        long = agg.unpivot("_n", cols, "col", "bad")
        out.append(long.select(
            status(F.col("bad"), F.try_divide(F.col("bad"), F.col("_n")) < 0.01).alias("status"),
            F.lit(t).alias("table_name"), F.concat(F.lit("critical completeness: "), F.col("col")).alias("check_name"),
            F.col("bad").cast("bigint").alias("bad_rows")))
    out.append(_from_counters(counters, [("notices", "pub_date_parsed", "pub_date parsed", "fail")]))
    return union_all(out)


def _anti_count(left: DataFrame, lkeys: list[str], right: DataFrame, rkeys: list[str]) -> DataFrame:
    lk = left.select(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(lkeys)])
    lk = lk.where(reduce(lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in range(len(lkeys))]))
    rk = right.select(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(rkeys)]).where(
        reduce(lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in range(len(rkeys))]))
    return lk.join(rk, [f"_k{i}" for i in range(len(lkeys))], "left_anti").agg(F.count(F.lit(1)).alias("bad"))


def check_notice_ref(tables: dict[str, DataFrame]) -> DataFrame:
    notices = tables["notices"]
    out = []
    for t, df in tables.items():
        if t == "notices":
            continue
        # every row counts here (a NULL notice id is unmatched too)
        ids = notices.select(F.col("notice_id").alias("_k0")).where(F.col("_k0").isNotNull())
        bad = (df.select(F.col("notice_id").alias("_k0")).join(ids, "_k0", "left_anti")
               .agg(F.count(F.lit(1)).alias("bad")))
        out.append(bad.select(status(F.col("bad")).alias("status"), F.lit(t).alias("table_name"),
                              F.lit("notice_id reference").alias("check_name"), F.col("bad").cast("bigint").alias("bad_rows")))
    return union_all(out)


REFS = [
    # (child table, child keys, parent table, parent keys, check name, warn-threshold)
    ("notices", ["notice_id", "buyer_org_id"], "organisations", ["notice_id", "org_id"],
     "buyer organisation reference", 25),
    ("lot_results", ["notice_id", "lot_id"], "lots", ["notice_id", "lot_id"], "lot reference", None),
    ("tenders", ["notice_id", "lot_id"], "lots", ["notice_id", "lot_id"], "lot reference", None),
    ("tenders", ["notice_id", "tendering_party_id"], "tendering_parties", ["notice_id", "party_id"],
     "tendering party reference", None),
    ("lot_results", ["notice_id", "winner_tender_id"], "tenders", ["notice_id", "tender_id"],
     "winner tender reference", None),
    ("contracts", ["notice_id", "lot_result_id"], "lot_results", ["notice_id", "lot_result_id"],
     "lot_result reference", None),
]


def check_refs(tables: dict[str, DataFrame]) -> DataFrame:
    out = []
    for child, ck, parent, pk, name, warn_max in REFS:
        bad = _anti_count(tables[child], ck, tables[parent], pk)
        st = status(F.col("bad"), (F.col("bad") <= warn_max) if warn_max is not None else None)
        out.append(bad.select(st.alias("status"), F.lit(child).alias("table_name"), F.lit(name).alias("check_name"),
                              F.col("bad").cast("bigint").alias("bad_rows")))
    return union_all(out)


def split_tender_ids(parties: DataFrame) -> DataFrame:
    """(notice_id, tender_id) for every comma-separated id, trimmed, empties dropped."""
    return (parties.where(F.col("notice_id").isNotNull() & F.col("tender_ids").isNotNull())
            .select("notice_id", F.explode(F.split("tender_ids", ",")).alias("tid"))
            .select("notice_id", F.trim("tid").alias("tender_id")).where(F.col("tender_id") != ""))


def check_list_ref(tables: dict[str, DataFrame]) -> DataFrame:
    ids = split_tender_ids(tables["tendering_parties"])
    bad = _anti_count(ids, ["notice_id", "tender_id"], tables["tenders"], ["notice_id", "tender_id"])
    return bad.select(status(F.col("bad")).alias("status"), F.lit("tendering_parties").alias("table_name"),
                      F.lit("tender_ids reference").alias("check_name"), F.col("bad").cast("bigint").alias("bad_rows"))


def check_format(tables: dict[str, DataFrame]) -> DataFrame:
    return _from_counters(table_counters(tables), [
        ("notices", "fmt:cpv_main", "cpv_main format", "fail"),
        ("cpv_codes", "fmt:cpv_code", "cpv_code format", "fail"),
        ("organisations", "fmt:org_country", "org_country format", "warn")])


def check_derived(tables: dict[str, DataFrame]) -> DataFrame:
    return _from_counters(table_counters(tables), [
        ("notices", "derived:cpv_division", "cpv_division derivation", "fail"),
        ("lot_results", "derived:is_awarded", "is_awarded mapping", "fail"),
        ("lot_results", "derived:result_status", "result_status mapping", "fail")])


def check_domain(tables: dict[str, DataFrame]) -> DataFrame:
    return _from_counters(table_counters(tables), [
        ("lot_results", "domain:result_code", "result_code domain", "warn"),
        ("lot_results", "domain:result_status", "result_status domain", "warn")])


def check_floor(tables: dict[str, DataFrame]) -> DataFrame:
    return _from_counters(table_counters(tables), [
        ("contracts", "floor:contract_value", "contract_value non-negative", "fail"),
        ("tendering_parties", "floor:num_tenders", "num_tenders non-negative", "fail"),
        ("tenders", "floor:tender_value", "tender_value non-negative", "warn"),
        ("tenders", "floor:rank", "rank domain", "warn")])


def check_list_count(tables: dict[str, DataFrame]) -> DataFrame:
    return _from_counters(table_counters(tables), [
        ("tendering_parties", "list_count", "tender_ids count", "fail")])


def all_checks(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([check_primary_key(tables), check_completeness(tables), check_notice_ref(tables),
                      check_refs(tables), check_list_ref(tables), check_format(tables), check_derived(tables),
                      check_domain(tables), check_floor(tables), check_list_count(tables)])
