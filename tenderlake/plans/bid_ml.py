"""Bid-level and notice-level ML features, splits and metrics (O-ML-10..22).

The winner of a lot is the tender that its lot result names; results are joined to the
tenders on (notice, lot), so that bids of lots without a named winner don't count.
The award-value dataset is the notice-grain award mart (awarded value > 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import text as T
from ..registry import query
from . import common as K
from .competition import average_rank
from .oracle_base import add_ctes

ORDER_COLS = ["pub_date", "notice_id", "lot_id", "tender_id"]
FEATS = ["price_rank_pct", "is_cheapest", "gap_to_min", "value_z", "log_value", "n_bids", "supplier_winrate",
         "sub_yes", "ac_price", "ac_quality", "cheap_x_price"]
# FIXED VALUES (also the feature names above): target-encoding weight, procurement types one-hot encoded.
TE_WEIGHT = 20
ONE_HOT_TYPES = ("Services", "Supplies", "Works")


def competitive_bids(lake) -> DataFrame:
    """Tenders with a positive value in lots with >= 2 bids and exactly one winner, the lot result's."""
    def build():
        won = (lake.silver("lot_results").where(F.col("winner_tender_id").isNotNull())
               .select("notice_id", "lot_id", "winner_tender_id"))
        t = lake.silver("tenders").select(
            "notice_id", "tender_id", "lot_id", "tendering_party_id", "tender_value", "subcontracting").join(
            won, ["notice_id", "lot_id"]).withColumn(
            "is_winner", (F.col("tender_id") == F.col("winner_tender_id")).cast("int")).drop("winner_tender_id")
        n = lake.silver("notices").select("notice_id", "pub_date", "cpv_division", "buyer_country")
        lots = lake.silver("lots")
        lots = lots.select("notice_id", "lot_id", (F.col("award_criteria") if "award_criteria" in lots.columns
                                                   else F.lit(None).cast("string")).alias("award_criteria"))
        df = (t.where(F.col("tender_value") > 0).join(n, "notice_id", "left")
              .join(lots, ["notice_id", "lot_id"], "left"))
        stats = df.groupBy("notice_id", "lot_id").agg(
            F.count(F.lit(1)).alias("n_bids"), F.sum("is_winner").alias("n_win"),
            F.min("tender_value").alias("lot_min"), F.avg("tender_value").alias("lot_mean"),
            F.coalesce(F.stddev_samp("tender_value"), F.lit(0.0)).alias("lot_std"))
        return (df.join(stats.where((F.col("n_bids") >= 2) & (F.col("n_win") == 1)), ["notice_id", "lot_id"])
                .drop("n_win"))
    return lake.derived("competitive_bids", build)


def _order() -> list[Column]:
    return [F.col("pub_date").asc_nulls_last(), F.col("notice_id"), F.col("lot_id"), F.col("tender_id")]


def supplier_history_df(lake) -> DataFrame:
    """Prior bids / wins of the bidding party before each bid (leakage-safe)."""
    def build():
        b = competitive_bids(lake)
        r = K.running_by_group(lake.spark, b, ["tendering_party_id"], _order(), value="is_winner")
        return r.withColumns({
            "prior_bids": F.col("group_rank") - 1,
            "prior_wins": F.col("group_running") - F.col("is_winner"),
        }).withColumn("supplier_winrate", (F.col("prior_wins") + 1.0) / (F.col("prior_bids") + 5.0)).drop(
            "group_rank", "group_running")
    return lake.derived("supplier_history", build)


def bid_features_df(lake) -> DataFrame:
    def build():
        h = supplier_history_df(lake)
        # exact min-rank of each bid's value inside its lot, skew-safe
        r = K.running_by_group(lake.spark, h.select("notice_id", "lot_id", "tender_id", "tender_value"),
                               ["notice_id", "lot_id"], [F.col("tender_value"), F.col("tender_id")],
                               rank_col="_vpos")
        rmin = r.groupBy("notice_id", "lot_id", "tender_value").agg(F.min("_vpos").alias("_rank_min"))
        f = h.join(rmin, ["notice_id", "lot_id", "tender_value"])
        ac = F.lower(F.coalesce(F.col("award_criteria").cast("string"), F.lit("")))
        f = f.withColumns({
            "price_rank_pct": (F.col("_rank_min") - 1) / (F.col("n_bids") - 1),
            "is_cheapest": (F.col("tender_value") <= F.col("lot_min")).cast("double"),
            "gap_to_min": (F.col("tender_value") - F.col("lot_min")) / F.col("lot_mean"),
            "value_z": F.when(F.col("lot_std") != 0, (F.col("tender_value") - F.col("lot_mean")) / F.col("lot_std"))
            .otherwise(0.0),
            "log_value": F.log1p("tender_value"),
            "sub_yes": (F.coalesce(F.col("subcontracting"), F.lit("")) == "yes").cast("double"),
            "ac_price": (ac == "price").cast("double"),
            "ac_quality": (ac == "quality").cast("double"),
        }).withColumn("cheap_x_price", F.col("is_cheapest") * F.col("ac_price")).drop("_rank_min")
        return f
    return lake.derived("bid_features", build, persist=True)


def lot_split_df(lake, q: float = 0.8) -> DataFrame:
    """Lots ordered by first publication date; bids of lots at or below the
    0.8 quantile of the (row-level) lot order are training rows."""
    def build():
        f = bid_features_df(lake)
        lots = f.groupBy("notice_id", "lot_id").agg(F.min("pub_date").alias("_first"))
        ranked = K.global_rank(lake.spark, lots, [F.col("_first").asc_nulls_last(), F.col("notice_id"),
                                                   F.col("lot_id")], rank_col="_r")
        lo = f.join(ranked.select("notice_id", "lot_id", (F.col("_r") - 1).alias("lot_order")), ["notice_id", "lot_id"])
        lo = K.checkpointed(lake.spark, lo)
        cutoff = K.grouped_quantiles(lake.spark, lo, [], "lot_order", {"cutoff": q}).scalar()
        return lo.withColumn("is_train", F.col("lot_order") <= cutoff)
    return lake.derived("lot_split", build, persist=True)


BIDS_SQL = f"""
SELECT * FROM (
  SELECT t.notice_id, t.tender_id, t.lot_id, t.tendering_party_id, t.tender_value, t.subcontracting,
    CAST(t.tender_id = r.winner_tender_id AS INTEGER) AS is_winner, n.pub_date, n.cpv_division,
    n.buyer_country, CAST(NULL AS VARCHAR) AS award_criteria,
    count(*) OVER (PARTITION BY t.notice_id, t.lot_id) AS n_bids,
    sum(CAST(t.tender_id = r.winner_tender_id AS INTEGER)) OVER (PARTITION BY t.notice_id, t.lot_id) AS n_win,
    min(t.tender_value) OVER (PARTITION BY t.notice_id, t.lot_id) AS lot_min,
    avg(t.tender_value) OVER (PARTITION BY t.notice_id, t.lot_id) AS lot_mean,
    COALESCE(stddev_samp(t.tender_value) OVER (PARTITION BY t.notice_id, t.lot_id), 0.0) AS lot_std
  FROM s_tenders t JOIN s_lot_results r ON r.notice_id = t.notice_id AND r.lot_id = t.lot_id AND r.winner_tender_id IS NOT NULL
  LEFT JOIN s_notices n ON n.notice_id = t.notice_id
  WHERE t.tender_value > 0)
WHERE n_bids >= 2 AND n_win = 1"""

add_ctes([
    ("bid_cb", BIDS_SQL),
    ("bid_sh", """SELECT * EXCLUDE (n_win), (prior_wins + 1.0) / (prior_bids + 5.0) AS supplier_winrate
FROM (SELECT *, row_number() OVER w - 1 AS prior_bids, CAST(sum(is_winner) OVER w - is_winner AS BIGINT) AS prior_wins
      FROM bid_cb
      WINDOW w AS (PARTITION BY tendering_party_id ORDER BY pub_date NULLS LAST, notice_id, lot_id, tender_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""),
    ("bid_bf", """SELECT *, is_cheapest * ac_price AS cheap_x_price FROM (
  SELECT *, (rank() OVER (PARTITION BY notice_id, lot_id ORDER BY tender_value) - 1) * 1.0 / (n_bids - 1) AS price_rank_pct,
    CAST(tender_value <= lot_min AS DOUBLE) AS is_cheapest, (tender_value - lot_min) / lot_mean AS gap_to_min,
    CASE WHEN lot_std <> 0 THEN (tender_value - lot_mean) / lot_std ELSE 0.0 END AS value_z,
    ln(1 + tender_value) AS log_value, CAST(COALESCE(subcontracting, '') = 'yes' AS DOUBLE) AS sub_yes,
    CAST(lower(COALESCE(award_criteria, '')) = 'price' AS DOUBLE) AS ac_price,
    CAST(lower(COALESCE(award_criteria, '')) = 'quality' AS DOUBLE) AS ac_quality
  FROM bid_sh)"""),
    ("bid_ls_lo", """SELECT notice_id, lot_id, row_number() OVER (ORDER BY first_pub NULLS LAST, notice_id, lot_id) - 1 AS lot_order
FROM (SELECT notice_id, lot_id, min(pub_date) AS first_pub FROM bid_bf GROUP BY 1, 2)"""),
    ("bid_ls", """SELECT bid_bf.*, lo.lot_order, lo.lot_order <= (SELECT quantile_cont(l2.lot_order, 0.8) FROM bid_bf b2
    JOIN bid_ls_lo l2 ON l2.notice_id = b2.notice_id AND l2.lot_id = b2.lot_id) AS is_train
FROM bid_bf JOIN bid_ls_lo lo ON lo.notice_id = bid_bf.notice_id AND lo.lot_id = bid_bf.lot_id"""),
])

BID_COLS = ["notice_id", "lot_id", "tender_id", "tendering_party_id", "tender_value", "is_winner", "n_bids"]


@query("competitive_bids", sql="SELECT " + ", ".join(BID_COLS) + ", lot_min, lot_mean, lot_std FROM bid_cb")
def competitive_bids_q(lake):
    """Bids of competitive lots (>= 2 positive bids, exactly one winner) with lot price stats."""
    return competitive_bids(lake).select(*BID_COLS, "lot_min", "lot_mean", "lot_std")


@query("supplier_history", sql="SELECT notice_id, lot_id, tender_id, tendering_party_id, is_winner, prior_bids, "
       "prior_wins, supplier_winrate FROM bid_sh")
def supplier_history(lake):
    """Leakage-safe supplier track record: prior bids, prior wins, (w + 1) / (b + 5)."""
    return supplier_history_df(lake).select("notice_id", "lot_id", "tender_id", "tendering_party_id", "is_winner",
                                            "prior_bids", "prior_wins", "supplier_winrate")


@query("bid_features", sql="SELECT notice_id, lot_id, tender_id, is_winner, " + ", ".join(FEATS) + " FROM bid_bf")
def bid_features(lake):
    """Bid-relative features: price rank, cheapest flag, gap, z-score, log value, criteria flags."""
    return bid_features_df(lake).select("notice_id", "lot_id", "tender_id", "is_winner", *FEATS)


@query("lot_split", sql="SELECT notice_id, lot_id, tender_id, lot_order, is_train FROM bid_ls")
def lot_split(lake):
    """Time-ordered split by lot (0.8 quantile of the lot order over bids)."""
    return lot_split_df(lake).select("notice_id", "lot_id", "tender_id", "lot_order", "is_train")


def _test_scored(lake) -> DataFrame:
    """Held-out bids scored by the supplier track record (a deterministic score)."""
    return (lot_split_df(lake).where(~F.col("is_train"))
            .select("notice_id", "lot_id", "tender_id", "tender_value", "is_winner",
                    F.col("supplier_winrate").alias("score")))


def binary_metrics_df(spark, scored: DataFrame) -> DataFrame:
    """ROC-AUC by rank sum (average ranks for ties), average precision
    (score desc, ids as tie-break) and log loss."""
    r = average_rank(spark, scored, "score", "_ar")
    auc = r.agg(((F.sum(F.when(F.col("is_winner") == 1, F.col("_ar")))
                  - F.sum("is_winner") * (F.sum("is_winner") + 1) / 2)
                 / (F.sum("is_winner") * (F.count(F.lit(1)) - F.sum("is_winner")))).alias("roc_auc"))
    g = K.global_rank(spark, scored, [F.col("score").desc(), F.col("notice_id"), F.col("lot_id"), F.col("tender_id")],
                      value="is_winner", rank_col="_k", running_col="_tp")
    ap = g.agg((F.sum(F.when(F.col("is_winner") == 1, F.col("_tp") / F.col("_k"))) / F.sum("is_winner"))
               .alias("average_precision"))
    eps = 1e-12
    ll = scored.agg((-F.avg(F.col("is_winner") * F.log(F.col("score") + eps)
                            + (1 - F.col("is_winner")) * F.log(1 - F.col("score") + eps))).alias("log_loss"),
                    F.count(F.lit(1)).alias("n"))
    return ll.select("n", auc.select("roc_auc").scalar().alias("roc_auc"),
                     ap.select("average_precision").scalar().alias("average_precision"), "log_loss")


@query("binary_metrics", sql="""
WITH t AS (SELECT notice_id, lot_id, tender_id, is_winner, supplier_winrate AS score FROM bid_ls WHERE NOT is_train),
ar AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM t),
ap AS (SELECT *, sum(is_winner) OVER w AS tp, row_number() OVER w AS k FROM t
       WINDOW w AS (ORDER BY score DESC, notice_id, lot_id, tender_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT (SELECT count(*) FROM t) AS n,
  (SELECT (sum(r) FILTER (WHERE is_winner = 1) - sum(is_winner) * (sum(is_winner) + 1) / 2.0)
          / (sum(is_winner) * (count(*) - sum(is_winner))) FROM ar) AS roc_auc,
  (SELECT sum(tp * 1.0 / k) FILTER (WHERE is_winner = 1) / sum(is_winner) FROM ap) AS average_precision,
  (SELECT -avg(is_winner * ln(score + 1e-12) + (1 - is_winner) * ln(1 - score + 1e-12)) FROM t) AS log_loss""")
def binary_metrics(lake):
    """ROC-AUC, average precision and log loss of the supplier track-record score on held-out bids."""
    return binary_metrics_df(lake.spark, _test_scored(lake))


def ranking_metrics_df(scored: DataFrame) -> DataFrame:
    """Per lot: winner's rank by score (ties: tender id) -> P@1, MRR; cheapest-bid baseline."""
    key = ["notice_id", "lot_id"]
    w = scored.groupBy(*key).agg(
        F.max_by(F.struct("score", "tender_id"), F.col("is_winner")).alias("_w"),
        F.min_by("is_winner", F.struct("tender_value", "tender_id")).alias("_cheapest_wins"))
    j = scored.join(w, key)
    better = (F.col("score") > F.col("_w.score")) | (
        (F.col("score") == F.col("_w.score")) & (F.col("tender_id") < F.col("_w.tender_id")))
    per_lot = j.groupBy(*key).agg((F.count_if(better) + 1).alias("_rank"), F.first("_cheapest_wins").alias("_c"))
    return per_lot.agg(F.count(F.lit(1)).alias("n_lots"),
                       F.avg((F.col("_rank") == 1).cast("double")).alias("precision_at_1"),
                       F.avg(1.0 / F.col("_rank")).alias("mrr"),
                       F.avg(F.col("_c").cast("double")).alias("cheapest_baseline_p1"))


@query("ranking_metrics", sql="""
WITH t AS (SELECT notice_id, lot_id, tender_id, tender_value, is_winner, supplier_winrate AS score FROM bid_ls
           WHERE NOT is_train),
r AS (SELECT *, row_number() OVER (PARTITION BY notice_id, lot_id ORDER BY score DESC, tender_id) AS rk,
        row_number() OVER (PARTITION BY notice_id, lot_id ORDER BY tender_value, tender_id) AS pk FROM t)
SELECT count(*) AS n_lots, avg(CASE WHEN rk = 1 THEN 1.0 ELSE 0.0 END) AS precision_at_1, avg(1.0 / rk) AS mrr,
  (SELECT avg(CAST(is_winner AS DOUBLE)) FROM r WHERE pk = 1) AS cheapest_baseline_p1
FROM r WHERE is_winner = 1""")
def ranking_metrics(lake):
    """Per-lot ranking quality (P@1, MRR) of the track-record score vs the cheapest-bid baseline."""
    return ranking_metrics_df(_test_scored(lake))


# ---------------------------------------------------------------- notice-level value model data

def value_base(lake) -> DataFrame:
    def build():
        a = (lake.gold("gold_notice_awards", "notice_id", "pub_date", "cpv_division", "buyer_country", "proc_type", "estimated",
                       "awarded_eur").where(F.col("awarded_eur") > 0)
             .select("notice_id", "pub_date", "cpv_division", "buyer_country", "proc_type",
                     F.col("estimated").alias("estimated_value"), "awarded_eur",
                     F.log1p("awarded_eur").alias("y")))
        return T.time_split(lake.spark, a, [F.col("pub_date").asc_nulls_last(), F.col("notice_id")])
    return lake.derived("value_base", build)


def target_encode_df(lake, weight: int = TE_WEIGHT) -> DataFrame:
    """Smoothed mean target per category from training rows only; unseen -> global mean."""
    b = value_base(lake)
    tr = b.where(F.col("is_train"))
    gm = tr.select(F.avg("y")).scalar()
    out = b
    for col in ("cpv_division", "buyer_country"):
        enc = (tr.where(F.col(col).isNotNull()).groupBy(col)
               .agg(((F.avg("y") * F.count(F.lit(1)) + gm * weight) / (F.count(F.lit(1)) + weight)).alias(f"{col}_te")))
        out = out.join(enc, col, "left").withColumn(f"{col}_te", F.coalesce(F.col(f"{col}_te"), gm))
    return out


VB_SQL = """vb AS (SELECT *, rk <= floor(0.8 * n) AS is_train FROM (
    SELECT notice_id, pub_date, cpv_division, buyer_country, proc_type, estimated AS estimated_value, awarded_eur,
      ln(1 + awarded_eur) AS y, row_number() OVER (ORDER BY pub_date NULLS LAST, notice_id) AS rk, count(*) OVER () AS n
    FROM gold_notice_awards WHERE awarded_eur > 0)),
gm AS (SELECT avg(y) AS g FROM vb WHERE is_train),
te_cpv AS (SELECT cpv_division, (avg(y) * count(*) + (SELECT g FROM gm) * 20) / (count(*) + 20) AS cpv_division_te
           FROM vb WHERE is_train AND cpv_division IS NOT NULL GROUP BY 1),
te_cty AS (SELECT buyer_country, (avg(y) * count(*) + (SELECT g FROM gm) * 20) / (count(*) + 20) AS buyer_country_te
           FROM vb WHERE is_train AND buyer_country IS NOT NULL GROUP BY 1),
vte AS (SELECT vb.*, COALESCE(c.cpv_division_te, (SELECT g FROM gm)) AS cpv_division_te,
          COALESCE(t.buyer_country_te, (SELECT g FROM gm)) AS buyer_country_te
        FROM vb LEFT JOIN te_cpv c ON c.cpv_division = vb.cpv_division LEFT JOIN te_cty t ON t.buyer_country = vb.buyer_country)"""


@query("target_encode", sql=f"WITH {VB_SQL} SELECT notice_id, is_train, y, cpv_division_te, buyer_country_te FROM vte")
def target_encode(lake):
    """Smoothed target encoding (weight 20) of CPV division and country, fitted on the training split."""
    return target_encode_df(lake).select("notice_id", "is_train", "y", "cpv_division_te", "buyer_country_te")


def value_features_df(lake) -> DataFrame:
    t = target_encode_df(lake)
    le = F.log1p("estimated_value")
    med = K.median_of(t.where(F.col("is_train")).select(le.alias("le")), "le")
    return t.withColumns({
        "est_missing": le.isNull().cast("double"),
        "log_estimated": F.coalesce(le, med),
        **{f"pt_{p}": (F.col("proc_type") == p).cast("double") for p in ONE_HOT_TYPES},
    }).withColumns({f"pt_{p}": F.coalesce(F.col(f"pt_{p}"), F.lit(0.0)) for p in ONE_HOT_TYPES})


VALUE_FEATS = ["log_estimated", "est_missing", "cpv_division_te", "buyer_country_te"] + [f"pt_{p}" for p in ONE_HOT_TYPES]


VALUE_ROWS_SQL = f"""{VB_SQL},
vrows AS (SELECT notice_id, is_train, y, estimated_value, awarded_eur, COALESCE(ln(1 + estimated_value),
    (SELECT median(ln(1 + estimated_value)) FROM vb WHERE is_train)) AS log_estimated,
  CAST(estimated_value IS NULL AS DOUBLE) AS est_missing, cpv_division_te, buyer_country_te,
  """ + ", ".join(f"CAST(COALESCE(proc_type = '{p}', false) AS DOUBLE) AS pt_{p}" for p in ONE_HOT_TYPES) + " FROM vte)"


@query("value_features", sql=f"WITH {VALUE_ROWS_SQL} SELECT notice_id, is_train, y, {', '.join(VALUE_FEATS)} FROM vrows")
def value_features(lake):
    """Award-value features: median-imputed log estimate + missing flag, target encodings, type one-hot."""
    return value_features_df(lake).select("notice_id", "is_train", "y", *VALUE_FEATS)


def regression_report(df: DataFrame, name: str, yhat: str = "yhat", y: str = "y") -> DataFrame:
    err = F.col(yhat) - F.col(y)
    # total sum of squares in one pass: sum(y^2) - sum(y)^2 / n
    sst = F.sum(F.col(y) * F.col(y)) - F.sum(y) * F.sum(y) / F.count(F.lit(1))
    df = K.checkpointed(df.sparkSession, df.select(yhat, y))  # predictions: made once, read twice
    ape = df.select((F.abs(F.expm1(yhat) - F.expm1(y)) / F.expm1(y)).alias("ape"))
    return df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n"), F.avg(F.abs(err)).alias("mae"),
                  F.sqrt(F.avg(err * err)).alias("rmse"),
                  (1 - F.sum(err * err) / sst).alias("r2")).withColumn("median_ape", K.median_of(ape, "ape") * 100)


@query("median_baseline", sql=f"""WITH {VB_SQL},
med AS (SELECT median(y) AS m FROM vb WHERE is_train),
cm AS (SELECT cpv_division, median(y) AS cmed FROM vb WHERE is_train AND cpv_division IS NOT NULL GROUP BY 1),
p AS (SELECT 'global_median' AS model, y, (SELECT m FROM med) AS yhat FROM vb WHERE NOT is_train
      UNION ALL SELECT 'cpv_median', y, COALESCE(cm.cmed, (SELECT m FROM med)) FROM vb LEFT JOIN cm
        ON cm.cpv_division = vb.cpv_division WHERE NOT is_train)
SELECT model, count(*) AS n, avg(abs(yhat - y)) AS mae, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
  1 - sum((yhat - y) * (yhat - y)) / sum((y - (SELECT avg(y) FROM vb WHERE NOT is_train))
                                        * (y - (SELECT avg(y) FROM vb WHERE NOT is_train))) AS r2,
  median(abs((exp(yhat) - 1) - (exp(y) - 1)) / (exp(y) - 1)) * 100 AS median_ape
FROM p GROUP BY model""")
def median_baseline(lake):
    """Regression metrics (MAE, RMSE, R2, median APE) of the global- and per-CPV-median baselines."""
    b = value_base(lake)
    tr, te = b.where(F.col("is_train")), b.where(~F.col("is_train"))
    m = K.median_of(tr, "y")
    cm = K.grouped_median(lake.spark, tr.where(F.col("cpv_division").isNotNull()), ["cpv_division"], "y", "_cm")
    g = regression_report(te.withColumn("yhat", m), "global_median")
    c = regression_report(te.join(cm, "cpv_division", "left").withColumn("yhat", F.coalesce("_cm", m)), "cpv_median")
    return g.unionByName(c)


@query("target_profile", sql="""
SELECT count(*) AS n_rows, count(awarded_eur) AS n_target, count(awarded_eur) * 100.0 / count(*) AS pct_non_null,
  count(*) FILTER (WHERE awarded_eur > 0) AS n_usable, avg(ln(1 + awarded_eur)) FILTER (WHERE awarded_eur > 0) AS mean_log,
  stddev_samp(ln(1 + awarded_eur)) FILTER (WHERE awarded_eur > 0) AS std_log,
  min(ln(1 + awarded_eur)) FILTER (WHERE awarded_eur > 0) AS min_log,
  quantile_cont(ln(1 + awarded_eur), 0.25) FILTER (WHERE awarded_eur > 0) AS p25_log,
  median(ln(1 + awarded_eur)) FILTER (WHERE awarded_eur > 0) AS median_log,
  quantile_cont(ln(1 + awarded_eur), 0.75) FILTER (WHERE awarded_eur > 0) AS p75_log,
  max(ln(1 + awarded_eur)) FILTER (WHERE awarded_eur > 0) AS max_log
FROM gold_notice_awards""")
def target_profile(lake):
    """Target profile: non-null %, usable rows, describe() of log1p(value)."""
    a = lake.gold("gold_notice_awards")
    ly = F.when(F.col("awarded_eur") > 0, F.log1p("awarded_eur"))
    quantiles = K.checkpointed(lake.spark, K.grouped_quantiles(
        lake.spark, a.select(ly.alias("ly")), [], "ly", {"p25_log": 0.25, "median_log": 0.5, "p75_log": 0.75}))
    return a.agg(F.count(F.lit(1)).alias("n_rows"), F.count("awarded_eur").alias("n_target"),
                 (F.count("awarded_eur") * 100.0 / F.count(F.lit(1))).alias("pct_non_null"),
                 F.count_if(F.col("awarded_eur") > 0).alias("n_usable"), F.avg(ly).alias("mean_log"),
                 F.stddev_samp(ly).alias("std_log"), F.min(ly).alias("min_log"),
                 F.max(ly).alias("max_log")).withColumns({
        n: quantiles.select(n).scalar() for n in ("p25_log", "median_log", "p75_log")})


def is_framework(df: DataFrame) -> Column:
    """1 for notices that name a framework."""
    return F.col("framework").isNotNull().cast("int") if "framework" in df.columns else F.lit(0)


def mart_features_df(lake) -> DataFrame:
    a = lake.gold("gold_notice_awards")
    d = F.try_to_date("pub_date")
    notices = lake.silver("notices")
    a = a.join(notices.select("notice_id", is_framework(notices).alias("is_framework")), "notice_id", "left")
    return a.select(
        "notice_id", F.log1p(F.coalesce("estimated", F.lit(0.0))).alias("log_estimated"),
        F.log1p(F.coalesce("awarded_eur", F.lit(0.0))).alias("log_awarded"),
        F.col("cpv_division").try_cast("int").alias("cpv_div_int"), F.month(d).cast("bigint").alias("pub_month"),
        F.weekday(d).cast("bigint").alias("pub_weekday"), F.coalesce("is_framework", F.lit(0)).alias("is_framework"),
        F.coalesce(F.col("num_lots").cast("double"), F.lit(1.0)).alias("num_lots"),
        F.coalesce(F.col("sme_winner"), F.lit(False)).cast("int").alias("sme_winner_int"),
        "avg_tenders_per_lot", "awarded_eur", "proc_type", "buyer_country", "cpv_division")


@query("mart_features", sql="""
SELECT notice_id, ln(1 + COALESCE(estimated, 0.0)) AS log_estimated, ln(1 + COALESCE(awarded_eur, 0.0)) AS log_awarded,
  TRY_CAST(cpv_division AS INTEGER) AS cpv_div_int, month(TRY_CAST(pub_date AS DATE)) AS pub_month,
  isodow(TRY_CAST(pub_date AS DATE)) - 1 AS pub_weekday, 0 AS is_framework,
  COALESCE(CAST(num_lots AS DOUBLE), 1.0) AS num_lots, CAST(COALESCE(sme_winner, false) AS INTEGER) AS sme_winner_int,
  avg_tenders_per_lot, awarded_eur, proc_type, buyer_country, cpv_division
FROM gold_notice_awards""")
def mart_features(lake):
    """Mart features for the boosted models: logs, CPV as int, month, weekday, framework, lots, SME flag."""
    return mart_features_df(lake)
