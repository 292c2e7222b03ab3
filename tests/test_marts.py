"""Marts of some columns: the same rows, and nothing built that the columns do not need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenderlake.context import Lake
from tenderlake.operators import gold as G
from tenderlake.operators import silver as S
from tenderlake.plans import common as K
from tenderlake.plans import opportunity, volume
from tenderlake.sources import views as V

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lake(spark):
    lake = Lake(spark, SF, materialize=True)
    yield lake
    lake.close()


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("mart,columns", [
    ("gold_awards", ("notice_id", "lot_result_id", "buyer_country", "contract_value", "tenders_count")),
    ("gold_awards", ("lot_result_id", "winner_name", "tender_value", "notice_id")),
    ("gold_notices", ("notice_id", "estimated", "buyer_name")),
    ("gold_notices", ("notice_id", "tender_value", "cpv_codes", "lot_count")),
    ("gold_notice_awards", ("notice_id", "estimated", "awarded_eur")),
    ("gold_notice_awards", ("notice_id", "sme_winner", "savings_pct", "total_tenders")),
    ("gold_lots", ("notice_id", "lot_id", "contract_value", "cpv_division")),
])
def test_some_columns_of_a_mart_are_those_of_the_whole(spark, lake, mart, columns):
    some = lake.gold(mart, *columns)
    assert some.columns == list(columns) and mart not in lake._cache
    whole = lake.gold(mart)
    assert rows(some) == rows(whole.select(*columns))
    assert rows(lake.gold(mart, *columns)) == rows(some)


def test_studies_build_no_more_than_they_read(lake):
    opportunity.savings_base(lake).count()
    volume.daily_counts(lake).count()
    built = {n for n in lake._cache if n.startswith(("silver.", "gold_"))}
    assert not built & {"silver.tenders", "silver.lots", "silver.cpv_codes", "silver.tendering_parties", "gold_notices", "gold_awards"}
    assert {"silver.notices", "silver.lot_results", "silver.contracts"} <= built
    assert K.notice_awards(lake).count() == lake.gold("gold_awards").where(
        "buyer_country is not null and proc_type is not null and cpv_division is not null and cpv_division_name is not null"
    ).select("notice_id").distinct().count()


def test_dedupe_ships_a_value_once(spark):
    df = spark.createDataFrame([("a", "x1", 1.0), ("a", None, 2.0), ("b", "x2", None), ("b", "x3", None)], "k string, v string, lot_est double")
    best = S.dedupe_quality(df, ["k"])
    assert sorted(map(tuple, best.collect())) == [("a", "x1", 1.0), ("b", "x3", None)]
    shipped = best._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in shipped and len(S.dedupe_quality(df.withColumn("source_order", F.lit(1)), ["k"]).collect()) == 2


def test_sellers_stay_distinct_when_keys_repeat_or_are_null(spark, tmp_path):
    for t in ("orders", "customer", "supplier", "nation", "lineitem"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t in ("supplier", "nation"):
            df = df.unionByName(df)
        if t == "lineitem":
            df = df.limit(50).unionByName(df.limit(50)).unionByName(df.limit(5).withColumn("l_orderkey", F.lit(None).cast("long")))
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    li, s, n = (spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("lineitem", "supplier", "nation"))
    expected = (li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
                .select(F.col("l_orderkey").cast("string"), F.col("s_suppkey").cast("string"), "s_name", "n_name").distinct())
    got = V.src_organisations(spark, str(tmp_path)).where("source_order = 1").select("notice_id", "org_id", "org_name", "org_country")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, expected.collect())))
    assert G.MARTS


@pytest.mark.parametrize("query,spared", [
    ("estimate_coverage", {"silver.lots", "silver.lot_results", "silver.contracts", "silver.tenders", "silver.cpv_codes"}),
    ("savings_by_type", {"silver.lots", "silver.tenders"}),
    ("scatter_sample", {"silver.lots", "silver.tenders"}),
    ("round_number_flags", {"silver.lots", "silver.tenders"}),
    ("savings_histogram", {"silver.lots", "silver.tenders", "silver.contracts"}),
])
def test_queries_build_no_more_of_a_mart_than_they_read(lake, query, spared):
    """The same rows as over the whole mart, without the tables that give none of the columns."""
    from tenderlake import registry
    registry._load_all()
    slim = rows(registry.REGISTRY[query].fn(lake))
    assert not set(lake._cache) & {*spared, "gold_notices", "gold_awards"}
    lake.gold("gold_notices"), lake.gold("gold_awards")
    for made in [n for n in lake._cache if "-of-" in n]:
        del lake._cache[made]
    assert rows(registry.REGISTRY[query].fn(lake)) == slim


def test_keys_of_silver_tables_without_their_rows(spark, lake):
    """One row for each row of the table, whether it is there or not; the reference check decides no rows."""
    from tenderlake.plans import validation_queries as Q
    keys = {t: rows(lake.silver_keys(t)) for t in S.TRANSFORMS}
    checked = rows(Q.check_notice_ref(lake))
    assert not any(n.startswith("silver.") for n in lake._cache)
    for t in S.TRANSFORMS:
        lake.silver(t)
    assert {t: rows(lake.silver_keys(t)) for t in S.TRANSFORMS} == keys
    assert rows(Q.check_notice_ref(lake)) == checked


def test_catalog_counts_rows_without_building_what_does_not_decide_them(lake):
    """Rows, columns and types of every table as they are when it is built whole."""
    from tenderlake.plans import interactive
    from tenderlake.sources.catalog import GOLD, SILVER
    found = {r.table_name: (r.n_rows, r.n_columns, r.columns) for r in interactive.table_catalog(lake).collect()}
    built = {n for n in lake._cache if n.startswith(("silver.", "gold_"))}
    assert not built & {"silver.lots", "silver.tenders", "silver.cpv_codes", "silver.contracts", *GOLD}
    tables = {**{f"silver_{t}": lake.silver(t) for t in SILVER}, **{g: lake.gold(g) for g in GOLD}}
    assert found == {n: (df.count(), len(df.columns), ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields))
                     for n, df in tables.items()}
