"""Published versions: readers see one version whole, and marts join without exchanging the children."""

from __future__ import annotations

import re
import uuid

import pytest

from tenderlake.context import Lake, _join, ensure_checkpoint_dir
from tenderlake.operators import gold as G
from tenderlake.sources import published as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark):
    return _join(ensure_checkpoint_dir(spark), f"test-published-{uuid.uuid4().hex}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_readers_stay_on_their_version(spark, root):
    with pytest.raises(FileNotFoundError):
        P.current(spark, f"{root}/none")
    first = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "notice_id string, n int")
    second = spark.createDataFrame([("a", 10)], "notice_id string, n int")
    P.publish(spark, root, {"t": first, "u": first}, buckets=3)
    reader = P.current(spark, root)
    held = reader.table("t")
    assert rows(held) == rows(first)
    P.publish(spark, root, {"t": second, "u": second}, buckets=3)
    # The reader that was there before sees the old version in every table, a new one the new version.
    assert rows(held) == rows(reader.table("t")) == rows(reader.table("u")) == rows(first)
    now = P.current(spark, root)
    assert rows(now.table("t")) == rows(now.table("u")) == rows(second)
    # A publication that fails switches nothing.
    broken = second.selectExpr("notice_id", "raise_error('no') AS n")
    with pytest.raises(Exception):
        P.publish(spark, root, {"t": second, "u": broken}, buckets=3)
    assert P.current(spark, root).folder == now.folder
    gone = P.prune(spark, root, keep={reader.folder})
    assert len(gone) == 1 and rows(reader.table("t")) == rows(first)
    assert P.prune(spark, root) == [reader.folder] and rows(now.table("u")) == rows(second)
    reader.forget()
    now.forget()


def test_marts_over_published_silver_exchange_nothing(spark, root):
    lake = Lake.get(spark, SF)
    names = ["notices", "cpv_codes", "lots", "lot_results", "contracts", "tendering_parties", "tenders"]
    P.publish(spark, f"{root}-silver", {n: lake.silver(n) for n in names}, buckets=8)
    version = P.current(spark, f"{root}-silver")

    class Silver:
        def silver(self, name):
            return version.table(name)

        def derived(self, name, build, persist=False):
            return build()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = G.build_mart(Silver(), "gold_notices")
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"\bExchange\b", plan) and "SortMergeJoin" in plan
        assert mart.count() == lake.gold("gold_notices").count()
        key = mart.select("notice_id", "lot_count", "tender_count")
        assert rows(key) == rows(lake.gold("gold_notices").select("notice_id", "lot_count", "tender_count"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        version.forget()
