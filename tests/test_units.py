"""Hand-made fixtures for the null / tie / rounding / edge rules and the
distributed ranking helpers."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tenderlake.functions import cleaning as C
from tenderlake.operators import gold as G
from tenderlake.operators import silver as S
from tenderlake.plans import common as K
from tenderlake.plans.competition import average_rank


def test_clean_date_and_lenient_casts(spark):
    df = spark.createDataFrame([("2026-01-05+01:00", "12.5"), ("2026-01-06Z", "n/a"), (None, None),
                                ("2026-01-07-05:00", "NaN")], "d string, v string")
    rows = df.select(C.clean_date("d").alias("d"), C.to_double("v").alias("v"), C.to_int("v").alias("i")).collect()
    assert [r.d for r in rows] == ["2026-01-05", "2026-01-06", None, "2026-01-07"]
    assert [r.v for r in rows] == [12.5, None, None, None]
    assert [r.i for r in rows] == [12, None, None, None]


def test_flags_and_lookups(spark):
    df = spark.createDataFrame([("SMALL", "SELEC-W", "45000000", "WORKS"), ("micro", None, "99", "other"),
                                (None, "clos-nw", None, None)], "sme string, code string, cpv string, pt string")
    rows = df.select(C.sme_flag("sme").alias("s"), C.awarded_flag("code").alias("a"),
                     C.cpv_division_name(C.cpv_division("cpv")).alias("n"),
                     C.normalise_proc_type("pt").alias("p")).collect()
    assert [r.s for r in rows] == [True, False, False]          # 'micro' is not in the surveyed list
    assert [r.a for r in rows] == [True, False, False]
    assert [r.n for r in rows] == ["Construction works", None, None]
    assert [r.p for r in rows] == ["Works", "other", None]


def test_dedupe_real_date_beats_null_and_score_wins(spark):
    df = spark.createDataFrame([
        ("N1", None, 1.0, 3, "x"), ("N1", "2026-01-02", 1.0, 2, None),   # equal score: real date wins
        ("N2", "2026-01-01", -5.0, 1, "x"), ("N2", "2026-01-01", 5.0, 0, "x"),  # negative value loses 6 points
        ("N3", "2026-01-01", 1.0, 1, "x")],
        "notice_id string, pub_date string, estimated double, source_order int, extra string")
    out = {r.notice_id: r for r in S.dedupe_quality(df, ["notice_id"]).collect()}
    assert out["N1"].pub_date == "2026-01-02"
    assert out["N2"].estimated == 5.0
    assert len(out) == 3
    legacy = {r.notice_id: r for r in S.dedupe_quality(df, ["notice_id"], null_date_wins=True).collect()}
    assert legacy["N1"].pub_date is None


def test_dedupe_never_invents_rows_and_keys_unique(spark):
    rnd = random.Random(7)
    data = [(f"K{rnd.randint(0, 30)}", rnd.choice([None, 1.0, -1.0, 3.0]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, lot_est double, source_order int")
    out = S.dedupe_quality(df, ["k"])
    assert out.count() == df.select("k").distinct().count()
    assert out.join(df, ["k", "source_order"], "left_anti").count() == 0


def test_savings_half_even_and_tiers(spark):
    df = spark.createDataFrame([(100.0, 99.75), (100.0, 99.85), (0.0, 5.0), (None, 1.0)], "e double, a double")
    vals = [r.s for r in df.select(G.savings_pct(F.col("e"), F.col("a")).alias("s")).collect()]
    assert vals == [0.2, 0.2, None, None]                    # 0.25 -> 0.2, 0.15 -> 0.2 (half-even)
    t = spark.createDataFrame([(0.0,), (50_000.0,), (50_000.01,), (500_000.0,), (5_000_000.0,), (5e6 + 1,), (None,)],
                              "v double")
    right = [r.t for r in t.select(C.size_tier("v").alias("t")).collect()]
    assert right == [None, "Micro (<€50K)", "Small (€50K–500K)", "Small (€50K–500K)", "Mid (€500K–5M)",
                     "Large (>€5M)", None]
    left = [r.t for r in t.select(C.size_tier("v", "left", ("a", "b", "c", "d")).alias("t")).collect()]
    assert left == ["a", "b", "b", "c", "d", "d", None]


def test_sum_semantics(spark):
    df = spark.createDataFrame([("A", None), ("A", None), ("B", 2.0), ("B", -1.0)], "g string, v double")
    rows = {r.g: r for r in df.groupBy("g").agg(G.zero_sum("v").alias("z"),
                                                 F.sum(C.non_negative("v")).alias("nn")).collect()}
    assert rows["A"].z == 0 and rows["A"].nn is None        # pandas sum -> 0; min_count sum -> NULL
    assert rows["B"].nn == 2.0


def test_unique_join_sorted_distinct(spark):
    df = spark.createDataFrame([("n", "b"), ("n", "a"), ("n", "b"), ("n", ""), ("n", None)], "k string, v string")
    assert df.groupBy("k").agg(G.unique_join("v").alias("u")).first().u == "a, b"


def test_global_rank_matches_sorted_order(spark):
    rnd = random.Random(1)
    data = [(i, float(rnd.randint(0, 20))) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v double").repartition(7)
    r = K.global_rank(spark, df, [F.col("v").desc(), F.col("id")], value="v")
    got = sorted((x.rank, x.id, x.running) for x in r.collect())
    exp = sorted(data, key=lambda t: (-t[1], t[0]))
    run = 0.0
    for i, (idx, v) in enumerate(exp, 1):
        run += v
        assert got[i - 1][:2] == (i, idx)
        assert abs(got[i - 1][2] - run) < 1e-9


def test_running_by_group_with_hot_group(spark):
    rnd = random.Random(3)
    # one group holds a third of all rows
    data = [("HOT" if i % 3 == 0 else f"g{rnd.randint(0, 40)}", i, rnd.randint(0, 1)) for i in range(900)]
    df = spark.createDataFrame(data, "g string, t int, w int").repartition(5)
    out = {(r.g, r.t): (r.group_rank, r.group_running)
           for r in K.running_by_group(spark, df, ["g"], [F.col("t")], value="w").collect()}
    seen, wins = {}, {}
    for g, t, w in sorted(data, key=lambda x: (x[0], x[1])):
        seen[g] = seen.get(g, 0) + 1
        wins[g] = wins.get(g, 0) + w
        assert out[(g, t)] == (seen[g], wins[g])


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (2.0,)], "x double")
    ranks = sorted(r.r for r in average_rank(spark, df, "x", "r").collect())
    assert ranks == [1.0, 3.0, 3.0, 3.0, 5.0]


def test_empty_input(spark):
    empty = spark.createDataFrame([], "notice_id string, pub_date string, estimated double")
    assert S.dedupe_quality(empty, ["notice_id"]).count() == 0


def test_grouped_median_matches_pandas_with_hot_group(spark):
    import statistics
    rnd = random.Random(11)
    data = [("HOT" if i % 3 == 0 else f"g{rnd.randint(0, 9)}", float(rnd.randint(0, 500)) / 7) for i in range(1200)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: r.median for r in K.grouped_median(spark, df, ["g"], "v").collect()}
    groups = {}
    for g, v in data:
        groups.setdefault(g, []).append(v)
    for g, vals in groups.items():
        assert abs(got[g] - statistics.median(vals)) < 1e-9
    overall = K.grouped_median(spark, df, [], "v").first().median
    assert abs(overall - statistics.median([v for _, v in data])) < 1e-9
