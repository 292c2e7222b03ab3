"""Market-opportunity study (O-OPP-*), incl. the flagship country master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.lookups import SIZE_TIER_LABELS_PLAIN
from ..registry import query
from . import common as K
from .competition import EXCLUDED_SAVINGS_COUNTRY

EX = K.EX
CHE = EXCLUDED_SAVINGS_COUNTRY
TC = "tenders_count_avg"
# FIXED VALUES: focus category of the category profile (IT services) and the
# open-market bidder bar.
FOCUS_DIVISION = "72"
OPEN_MARKET_BIDDERS = 2.0
ARCHETYPES = ("Mega Buyer", "High-Value Low-Volume", "High-Volume Low-Value", "Balanced")
QUADRANTS = ("High Savings / Low Competition", "High Savings / High Competition",
             "Low Savings / High Competition", "Low Savings / Low Competition")
IT_CLASSES = ("Open IT Market", "Closed IT Market (high spend, solo-dominated)", "Competitive Small IT Market",
              "Low-Spend Low-Competition")


def solo(c: str = TC, strict: bool = False) -> Column:
    """Share (%) of notices with a single bidder; ``strict`` uses == 1, the
    default counts <= 1 (averages below one bidder are solo too)."""
    v = F.col(c)
    flag = (v == 1) if strict else (v <= 1)
    return F.avg(F.when(v.isNotNull(), flag.cast("double"))) * 100


SOLO_SQL = "avg(CASE WHEN tenders_count_avg <= 1 THEN 1.0 WHEN tenders_count_avg IS NOT NULL THEN 0.0 END) * 100"


def base(lake) -> DataFrame:
    """notice_awards + estimate and buyer name from the notice mart, with size tier."""
    def build():
        g = lake.gold("gold_notices", "notice_id", "estimated", "buyer_name")
        na = K.notice_awards(lake).join(g, "notice_id", "left")
        return na.withColumn("size_seg", C.size_tier("awarded_eur_total", "left", SIZE_TIER_LABELS_PLAIN))
    return lake.derived("opp_base", build)


def comp(lake) -> DataFrame:
    return base(lake).where(F.col("awarded_eur_total") > 0)


def exhun(lake) -> DataFrame:
    return comp(lake).where(F.col("buyer_country") != EX)


def notice_savings(lake) -> DataFrame:
    s = exhun(lake).where(F.col("estimated").isNotNull() & (F.col("estimated") > 0) & (F.col("buyer_country") != CHE))
    return s.withColumn("savings_pct", (F.col("estimated") - F.col("awarded_eur_total")) / F.col("estimated") * 100)


BASE_SQL = f"""ob AS (SELECT na.*, g.estimated, g.buyer_name,
    {K.tier_sql('na.awarded_eur_total', 'left', SIZE_TIER_LABELS_PLAIN)} AS size_seg
  FROM notice_awards na LEFT JOIN (SELECT notice_id, estimated, buyer_name FROM gold_notices) g
    ON g.notice_id = na.notice_id),
comp AS (SELECT * FROM ob WHERE awarded_eur_total > 0),
exhun AS (SELECT * FROM comp WHERE buyer_country <> '{EX}'),
nsav AS (SELECT *, (estimated - awarded_eur_total) / estimated * 100 AS savings_pct FROM exhun
         WHERE estimated IS NOT NULL AND estimated > 0 AND buyer_country <> '{CHE}')"""


@query("savings_base", sql=f"WITH {BASE_SQL} SELECT * FROM nsav")
def savings_base(lake):
    """Notice savings subset (estimate present and positive, two countries excluded)."""
    return notice_savings(lake)


def _top_divisions(df: DataFrame, k: int) -> DataFrame:
    g = df.groupBy("cpv_division", "cpv_division_name").agg(F.count(F.lit(1)).alias("_n"))
    return g.orderBy(F.col("_n").desc(), "cpv_division").limit(k).select("cpv_division")


def _top_countries(df: DataFrame, k: int) -> DataFrame:
    g = df.groupBy("buyer_country").agg(F.count(F.lit(1)).alias("_n"))
    return g.orderBy(F.col("_n").desc(), "buyer_country").limit(k).select("buyer_country")


@query("cpv_country_heatmap", sql=f"""WITH {BASE_SQL},
td AS (SELECT cpv_division FROM comp GROUP BY cpv_division, cpv_division_name ORDER BY count(*) DESC, cpv_division
       LIMIT 8),
tc AS (SELECT buyer_country FROM comp GROUP BY buyer_country ORDER BY count(*) DESC, buyer_country LIMIT 10)
SELECT cpv_division, cpv_division_name, buyer_country, count(DISTINCT notice_id) AS notice_count,
  median(tenders_count_avg) AS median_bidders
FROM comp WHERE cpv_division IN (SELECT * FROM td) AND buyer_country IN (SELECT * FROM tc)
GROUP BY 1, 2, 3 HAVING count(DISTINCT notice_id) >= 10""")
def cpv_country_heatmap(lake, countries: list[str] | None = None):
    """Median bidders for the top-8 CPV divisions x chosen countries (default: the
    10 busiest), cells with >= 10 notices (long form of the heat map)."""
    c = comp(lake)
    cells = c.join(_top_divisions(c, 8), "cpv_division", "left_semi")
    if countries:
        cells = cells.where(F.col("buyer_country").isin(*countries))
    else:
        cells = cells.join(_top_countries(c, 10), "buyer_country", "left_semi")
    g = cells.groupBy("cpv_division", "cpv_division_name", "buyer_country").agg(
        F.count_distinct("notice_id").alias("notice_count"), F.median(TC).alias("median_bidders"))
    return g.where(F.col("notice_count") >= 10)


@query("cpv_country_profile", sql=f"""WITH {BASE_SQL}
SELECT buyer_country, count(DISTINCT notice_id) AS notices, median(tenders_count_avg) AS median_bidders,
  avg(tenders_count_avg) AS mean_bidders, {SOLO_SQL} AS solo_pct
FROM comp WHERE cpv_division = '{FOCUS_DIVISION}' GROUP BY buyer_country HAVING count(DISTINCT notice_id) >= 5""")
def cpv_country_profile(lake, division: str = FOCUS_DIVISION):
    """One CPV division by country: notices, median / mean bidders, solo % (>= 5 notices)."""
    g = comp(lake).where(F.col("cpv_division") == division).groupBy("buyer_country").agg(
        F.count_distinct("notice_id").alias("notices"), F.median(TC).alias("median_bidders"),
        F.avg(TC).alias("mean_bidders"), solo().alias("solo_pct"))
    return g.where(F.col("notices") >= 5).orderBy(F.col("median_bidders").desc_nulls_last(), "buyer_country")


def _mode_by(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Most frequent ``value`` per ``keys`` (ties: smallest value)."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return n.groupBy(*keys).agg(F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value)))
                                .alias(out))


def _top_by_sum(df: DataFrame, keys: list[str], value: str, measure: str, out: str) -> DataFrame:
    """``value`` with the largest sum of ``measure`` per ``keys`` (ties: smallest value)."""
    s = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(measure).alias("_s"))
    return s.groupBy(*keys).agg(F.min_by(F.col(value), F.struct((-F.col("_s")).alias("s"), F.col(value)))
                                .alias(out))


def top_buyers(lake, k: int = 100) -> DataFrame:
    e = exhun(lake).where(F.col("buyer_name").isNotNull())
    g = e.groupBy("buyer_name", "buyer_country").agg(
        F.sum("awarded_eur_total").alias("total_spend_eur"), F.count_distinct("notice_id").alias("notice_count"))
    top = K.top_k(g, k, F.col("total_spend_eur").desc(), F.col("buyer_name"), F.col("buyer_country"))
    keys = ["buyer_name", "buyer_country"]
    mine = e.join(top.select(*keys), keys, "left_semi")     # only the top buyers' notices
    dom = _mode_by(mine, keys, "cpv_division_name", "dominant_cpv")
    med = K.grouped_median(lake.spark, mine, keys, "awarded_eur_total", "median_cv")
    return top.join(med, keys, "left").join(dom, keys, "left")


TOP_BUYERS_SQL = f"""bp AS (SELECT * FROM (
    SELECT buyer_name, buyer_country, sum(awarded_eur_total) AS total_spend_eur,
      count(DISTINCT notice_id) AS notice_count, median(awarded_eur_total) AS median_cv,
      row_number() OVER (ORDER BY sum(awarded_eur_total) DESC, buyer_name, buyer_country) AS rank
    FROM exhun WHERE buyer_name IS NOT NULL GROUP BY 1, 2) WHERE rank <= 100),
dc AS (SELECT buyer_name, buyer_country, cpv_division_name AS dominant_cpv FROM (
    SELECT buyer_name, buyer_country, cpv_division_name,
      row_number() OVER (PARTITION BY buyer_name, buyer_country ORDER BY count(*) DESC, cpv_division_name) AS rn
    FROM exhun WHERE buyer_name IS NOT NULL AND cpv_division_name IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1),
bpd AS (SELECT bp.*, dc.dominant_cpv FROM bp LEFT JOIN dc
        ON dc.buyer_name = bp.buyer_name AND dc.buyer_country = bp.buyer_country)"""


@query("buyer_profile", sql=f"WITH {BASE_SQL}, {TOP_BUYERS_SQL} SELECT * FROM bpd")
def buyer_profile(lake):
    """Top-100 buyers (ex-country) by spend with notices, median value, dominant CPV."""
    return top_buyers(lake)


def _archetyped(lake) -> DataFrame:
    bp = top_buyers(lake)
    spend_med = bp.select(F.median("total_spend_eur")).scalar()
    vol_med = bp.select(F.median("notice_count")).scalar()
    hi_s, hi_v = F.col("total_spend_eur") >= spend_med, F.col("notice_count") >= vol_med
    a1, a2, a3, a4 = ARCHETYPES
    return bp.withColumn("archetype", F.when(hi_s & hi_v, a1).when(hi_s, a2).when(hi_v, a3).otherwise(a4))


ARCH_SQL = f"""ba AS (SELECT *, CASE
    WHEN total_spend_eur >= (SELECT median(total_spend_eur) FROM bpd) AND notice_count >= (SELECT median(notice_count) FROM bpd) THEN '{ARCHETYPES[0]}'
    WHEN total_spend_eur >= (SELECT median(total_spend_eur) FROM bpd) THEN '{ARCHETYPES[1]}'
    WHEN notice_count >= (SELECT median(notice_count) FROM bpd) THEN '{ARCHETYPES[2]}'
    ELSE '{ARCHETYPES[3]}' END AS archetype FROM bpd)"""


@query("buyer_archetypes", sql=f"WITH {BASE_SQL}, {TOP_BUYERS_SQL}, {ARCH_SQL} SELECT * FROM ba")
def buyer_archetypes(lake):
    """2x2 buyer archetypes on the medians of the top-100 set."""
    return _archetyped(lake)


@query("archetype_summary", sql=f"""WITH {BASE_SQL}, {TOP_BUYERS_SQL}, {ARCH_SQL}
SELECT archetype, count(buyer_name) AS n_buyers, sum(total_spend_eur) / 1e9 AS total_spend_bn,
  avg(total_spend_eur) / 1e6 AS avg_spend_m, avg(notice_count) AS avg_notices FROM ba GROUP BY archetype""")
def archetype_summary(lake):
    """Buyers, spend and notices per archetype."""
    return (_archetyped(lake).groupBy("archetype")
            .agg(F.count("buyer_name").alias("n_buyers"), (F.sum("total_spend_eur") / 1e9).alias("total_spend_bn"),
                 (F.avg("total_spend_eur") / 1e6).alias("avg_spend_m"), F.avg("notice_count").alias("avg_notices"))
            .orderBy(F.col("total_spend_bn").desc()))


@query("size_overview", sql=f"""WITH {BASE_SQL},
ss AS (SELECT size_seg, count(DISTINCT notice_id) AS notices, sum(awarded_eur_total) / 1e9 AS spend_bn,
         round_even(sum(awarded_eur_total) * 100 / (SELECT sum(awarded_eur_total) FROM exhun), 1) AS pct_spend
       FROM exhun GROUP BY size_seg),
sc AS (SELECT size_seg, median(tenders_count_avg) AS median_bid, {SOLO_SQL} AS solo_pct FROM comp
       WHERE tenders_count_avg IS NOT NULL GROUP BY size_seg)
SELECT ss.*, sc.median_bid, sc.solo_pct FROM ss LEFT JOIN sc ON sc.size_seg = ss.size_seg""")
def size_overview(lake):
    """Per size tier: notices, spend, % spend (ex-country) + median bidders and solo % (all)."""
    e = exhun(lake)
    ss = e.groupBy("size_seg").agg(F.count_distinct("notice_id").alias("notices"),
                                   (F.sum("awarded_eur_total") / 1e9).alias("spend_bn"),
                                   F.sum("awarded_eur_total").alias("_raw"))
    ss = ss.withColumn("pct_spend", F.bround(F.col("_raw") * 100 / K.total(e, F.sum("awarded_eur_total")), 1)).drop("_raw")
    sc = (comp(lake).where(F.col(TC).isNotNull()).groupBy("size_seg")
          .agg(F.median(TC).alias("median_bid"), solo().alias("solo_pct")))
    return ss.join(sc, "size_seg", "left").orderBy(K.tier_order("size_seg", SIZE_TIER_LABELS_PLAIN))


@query("tier_top_cpv", sql=f"""WITH {BASE_SQL}
SELECT * FROM (SELECT size_seg, cpv_division_name, count(DISTINCT notice_id) AS n,
    sum(awarded_eur_total) / 1e6 AS spend_m,
    row_number() OVER (PARTITION BY size_seg ORDER BY count(DISTINCT notice_id) DESC, cpv_division_name) AS rank
  FROM exhun GROUP BY 1, 2) WHERE rank <= 5""")
def tier_top_cpv(lake):
    """Top-5 CPV divisions (by notices) within each size tier."""
    g = exhun(lake).groupBy("size_seg", "cpv_division_name").agg(
        F.count_distinct("notice_id").alias("n"), (F.sum("awarded_eur_total") / 1e6).alias("spend_m"))
    return K.top_k(g, 5, F.col("n").desc(), F.col("cpv_division_name"), partition=["size_seg"])


LARGE = SIZE_TIER_LABELS_PLAIN[3]


@query("large_tier_country", sql=f"""WITH {BASE_SQL},
lc AS (SELECT buyer_country, count(DISTINCT notice_id) AS notices_comp, median(tenders_count_avg) AS median_bidders,
         {SOLO_SQL} AS solo_pct FROM comp WHERE size_seg = '{LARGE}' AND tenders_count_avg IS NOT NULL GROUP BY 1),
ls AS (SELECT buyer_country, sum(awarded_eur_total) / 1e9 AS spend_bn FROM exhun WHERE size_seg = '{LARGE}' GROUP BY 1)
SELECT lc.*, ls.spend_bn, lc.median_bidders > (SELECT median(median_bidders) FROM lc) AS above_dataset_median,
  (SELECT median(median_bidders) FROM lc) AS dataset_median
FROM lc LEFT JOIN ls ON ls.buyer_country = lc.buyer_country WHERE notices_comp >= 10""")
def large_tier_country(lake):
    """Competition in the largest tier by country (>= 10 notices) with spend; vs the median of medians."""
    lc = (comp(lake).where((F.col("size_seg") == LARGE) & F.col(TC).isNotNull()).groupBy("buyer_country")
          .agg(F.count_distinct("notice_id").alias("notices_comp"), F.median(TC).alias("median_bidders"),
               solo().alias("solo_pct")))
    ls = (exhun(lake).where(F.col("size_seg") == LARGE).groupBy("buyer_country")
          .agg((F.sum("awarded_eur_total") / 1e9).alias("spend_bn")))
    med = lc.select(F.median("median_bidders")).scalar()
    return (lc.join(ls, "buyer_country", "left").where(F.col("notices_comp") >= 10)
            .withColumns({"above_dataset_median": F.col("median_bidders") > med, "dataset_median": med}))


@query("opportunity_quadrant", sql=f"""WITH {BASE_SQL},
cs AS (SELECT buyer_country, count(notice_id) AS n_savings, median(savings_pct) AS median_savings FROM nsav GROUP BY 1),
cc AS (SELECT buyer_country, count(notice_id) AS n_comp, median(tenders_count_avg) AS median_bidders,
         {SOLO_SQL} AS solo_rate_pct FROM comp WHERE tenders_count_avg IS NOT NULL GROUP BY 1),
om AS (SELECT cs.*, cc.n_comp, cc.median_bidders, cc.solo_rate_pct FROM cs JOIN cc ON cc.buyer_country = cs.buyer_country
       WHERE n_savings >= 30 AND n_comp >= 30),
th AS (SELECT median(median_savings) AS st, median(median_bidders) AS bt FROM om)
SELECT om.*, th.st AS savings_threshold, th.bt AS bidders_threshold,
  CASE WHEN median_savings >= th.st AND median_bidders < th.bt THEN '{QUADRANTS[0]}'
       WHEN median_savings >= th.st THEN '{QUADRANTS[1]}'
       WHEN median_bidders >= th.bt THEN '{QUADRANTS[2]}' ELSE '{QUADRANTS[3]}' END AS quadrant
FROM om, th""")
def opportunity_quadrant(lake):
    """Country savings vs competition quadrant; thresholds = medians across countries (n >= 30 each)."""
    saved = notice_savings(lake)
    cs = K.with_medians(saved.groupBy("buyer_country").agg(F.count("notice_id").alias("n_savings")), saved, ["buyer_country"],
                        {"median_savings": "savings_pct"})
    cc = (comp(lake).where(F.col(TC).isNotNull()).groupBy("buyer_country")
          .agg(F.count("notice_id").alias("n_comp"), F.median(TC).alias("median_bidders"),
               solo().alias("solo_rate_pct")))
    # Written, since both thresholds and the result read it.
    om = K.checkpointed(lake.spark, cs.join(cc, "buyer_country").where((F.col("n_savings") >= 30) & (F.col("n_comp") >= 30)))
    st = om.select(F.median("median_savings")).scalar()
    bt = om.select(F.median("median_bidders")).scalar()
    hs, hc = F.col("median_savings") >= st, F.col("median_bidders") >= bt
    q1, q2, q3, q4 = QUADRANTS
    return om.withColumns({"savings_threshold": st, "bidders_threshold": bt,
                           "quadrant": F.when(hs & ~hc, q1).when(hs, q2).when(hc, q3).otherwise(q4)})


def _focus(df: DataFrame) -> DataFrame:
    return df.where(F.col("cpv_division") == FOCUS_DIVISION)


def category_by_country(lake) -> DataFrame:
    rows = _focus(exhun(lake))
    fin = rows.groupBy("buyer_country").agg(
        F.count_distinct("notice_id").alias("notices_fin"), (F.sum("awarded_eur_total") / 1e9).alias("spend_bn"))
    fin = K.with_medians(fin, rows, ["buyer_country"], {"median_cv_m": "awarded_eur_total"}).withColumn(
        "median_cv_m", F.col("median_cv_m") / 1e6)
    cmp_ = _focus(comp(lake)).groupBy("buyer_country").agg(
        F.count_distinct("notice_id").alias("notices_comp"), F.median(TC).alias("median_bidders"),
        solo().alias("solo_pct"))
    j = fin.join(cmp_, "buyer_country", "full_outer")
    return j.where((F.col("notices_fin") >= 5) | (F.col("notices_comp") >= 5))


CAT_SQL = f"""fin AS (SELECT buyer_country, count(DISTINCT notice_id) AS notices_fin, sum(awarded_eur_total) / 1e9 AS spend_bn,
    median(awarded_eur_total) / 1e6 AS median_cv_m FROM exhun WHERE cpv_division = '{FOCUS_DIVISION}' GROUP BY 1),
cmp AS (SELECT buyer_country, count(DISTINCT notice_id) AS notices_comp, median(tenders_count_avg) AS median_bidders,
    {SOLO_SQL} AS solo_pct FROM comp WHERE cpv_division = '{FOCUS_DIVISION}' GROUP BY 1),
cat AS (SELECT COALESCE(fin.buyer_country, cmp.buyer_country) AS buyer_country, notices_fin, spend_bn, median_cv_m,
    notices_comp, median_bidders, solo_pct FROM fin FULL OUTER JOIN cmp ON fin.buyer_country = cmp.buyer_country
  WHERE notices_fin >= 5 OR notices_comp >= 5)"""


@query("category_profile", sql=f"WITH {BASE_SQL}, {CAT_SQL} SELECT * FROM cat")
def category_profile(lake):
    """Focus category by country: spend (ex-country) full-outer competition, solo %."""
    return category_by_country(lake).orderBy(F.col("spend_bn").desc_nulls_last(), "buyer_country")


@query("category_by_size", sql=f"""WITH {BASE_SQL},
s AS (SELECT size_seg, count(DISTINCT notice_id) AS notices, sum(awarded_eur_total) / 1e9 AS spend_bn FROM exhun
      WHERE cpv_division = '{FOCUS_DIVISION}' GROUP BY 1),
c AS (SELECT size_seg, median(tenders_count_avg) AS median_bidders, {SOLO_SQL} AS solo_pct FROM comp
      WHERE cpv_division = '{FOCUS_DIVISION}' AND tenders_count_avg IS NOT NULL GROUP BY 1)
SELECT s.*, c.median_bidders, c.solo_pct FROM s LEFT JOIN c ON c.size_seg = s.size_seg""")
def category_by_size(lake):
    """Focus category by size tier: notices and spend (ex-country), bidders and solo % (all)."""
    s = _focus(exhun(lake)).groupBy("size_seg").agg(F.count_distinct("notice_id").alias("notices"),
                                                    (F.sum("awarded_eur_total") / 1e9).alias("spend_bn"))
    c = (_focus(comp(lake)).where(F.col(TC).isNotNull()).groupBy("size_seg")
         .agg(F.median(TC).alias("median_bidders"), solo().alias("solo_pct")))
    return s.join(c, "size_seg", "left").orderBy(K.tier_order("size_seg", SIZE_TIER_LABELS_PLAIN))


@query("category_savings", sql=f"""WITH {BASE_SQL}
SELECT buyer_country, count(notice_id) AS n, median(savings_pct) AS med_savings, avg(savings_pct) AS mean_savings
FROM nsav WHERE cpv_division = '{FOCUS_DIVISION}' GROUP BY 1 HAVING count(notice_id) >= 5""")
def category_savings(lake):
    """Focus category savings by country (>= 5 notices)."""
    rows = _focus(notice_savings(lake))
    g = rows.groupBy("buyer_country").agg(F.count("notice_id").alias("n"), F.avg("savings_pct").alias("mean_savings"))
    g = K.with_medians(g, rows, ["buyer_country"], {"med_savings": "savings_pct"})
    return g.where(F.col("n") >= 5).orderBy(F.col("med_savings").desc(), "buyer_country")


@query("category_top_notices", sql=f"""WITH {BASE_SQL}
SELECT notice_id, buyer_name, buyer_country, awarded_eur_total, tenders_count_avg, size_seg,
  round_even(awarded_eur_total / 1e6, 1) AS spend_m
FROM exhun WHERE cpv_division = '{FOCUS_DIVISION}' ORDER BY awarded_eur_total DESC, notice_id LIMIT 20""")
def category_top_notices(lake):
    """The 20 largest notices of the focus category (ex-country)."""
    e = _focus(exhun(lake))
    return (e.orderBy(F.col("awarded_eur_total").desc(), "notice_id").limit(20)
            .select("notice_id", "buyer_name", "buyer_country", "awarded_eur_total", TC, "size_seg",
                    F.bround(F.col("awarded_eur_total") / 1e6, 1).alias("spend_m")))


@query("market_class", sql=f"""WITH {BASE_SQL}, {CAT_SQL},
it AS (SELECT * FROM cat WHERE notices_comp >= 10),
m AS (SELECT median(spend_bn) AS sm FROM it)
SELECT it.*, CASE
  WHEN spend_bn IS NOT NULL AND round(spend_bn, 12) >= round(m.sm, 12) AND median_bidders IS NOT NULL
    AND median_bidders >= {OPEN_MARKET_BIDDERS} THEN '{IT_CLASSES[0]}'
  WHEN spend_bn IS NOT NULL AND round(spend_bn, 12) >= round(m.sm, 12) THEN '{IT_CLASSES[1]}'
  WHEN median_bidders IS NOT NULL AND median_bidders >= {OPEN_MARKET_BIDDERS} THEN '{IT_CLASSES[2]}'
  ELSE '{IT_CLASSES[3]}' END AS market_type
FROM it, m""")
def market_class(lake):
    """Open / closed market classes for the focus category: spend >= median, bidders >= 2."""
    it = category_by_country(lake).where(F.col("notices_comp") >= 10)
    sm = it.select(F.median("spend_bn")).scalar()
    # the median is one of the countries' own sums, recomputed: compare at 12 decimals
    hs = F.col("spend_bn").isNotNull() & (F.round("spend_bn", 12) >= F.round(sm, 12))
    hc = F.col("median_bidders").isNotNull() & (F.col("median_bidders") >= OPEN_MARKET_BIDDERS)
    c1, c2, c3, c4 = IT_CLASSES
    return it.withColumn("market_type", F.when(hs & hc, c1).when(hs, c2).when(hc, c3).otherwise(c4))


@query("country_master", sql=f"""WITH {BASE_SQL},
sp AS (SELECT buyer_country, sum(awarded_eur_total) / 1e9 AS spend_bn, count(DISTINCT notice_id) AS notice_count
       FROM exhun GROUP BY 1),
cc AS (SELECT buyer_country, median(tenders_count_avg) AS median_bidders, {SOLO_SQL} AS solo_rate_pct FROM comp
       WHERE tenders_count_avg IS NOT NULL GROUP BY 1),
sv AS (SELECT buyer_country, median(savings_pct) AS median_savings_pct FROM nsav GROUP BY 1),
dc AS (SELECT buyer_country, cpv_division_name AS dominant_cpv FROM (SELECT buyer_country, cpv_division_name,
         row_number() OVER (PARTITION BY buyer_country ORDER BY count(*) DESC, cpv_division_name) AS rn
       FROM exhun WHERE cpv_division_name IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
tb AS (SELECT buyer_country, buyer_name AS top_buyer FROM (SELECT buyer_country, buyer_name,
         row_number() OVER (PARTITION BY buyer_country ORDER BY sum(awarded_eur_total) DESC, buyer_name) AS rn
       FROM exhun WHERE buyer_name IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)
SELECT sp.*, cc.median_bidders, cc.solo_rate_pct, sv.median_savings_pct, dc.dominant_cpv, tb.top_buyer
FROM sp LEFT JOIN cc ON cc.buyer_country = sp.buyer_country LEFT JOIN sv ON sv.buyer_country = sp.buyer_country
  LEFT JOIN dc ON dc.buyer_country = sp.buyer_country LEFT JOIN tb ON tb.buyer_country = sp.buyer_country
ORDER BY spend_bn DESC, sp.buyer_country LIMIT 15""")
def country_master(lake):
    """Flagship: per-country spend, competition, savings, dominant CPV and top buyer; top 15 by spend.

    Five country-keyed aggregates (each a partial + final hash aggregate keyed
    on buyer_country) left-joined on the same key, then a top-15 cut.
    """
    e = exhun(lake)
    sp = e.groupBy("buyer_country").agg((F.sum("awarded_eur_total") / 1e9).alias("spend_bn"),
                                        F.count_distinct("notice_id").alias("notice_count"))
    cc = (comp(lake).where(F.col(TC).isNotNull()).groupBy("buyer_country")
          .agg(F.median(TC).alias("median_bidders"), solo().alias("solo_rate_pct")))
    sv = K.grouped_median(lake.spark, notice_savings(lake), ["buyer_country"], "savings_pct", "median_savings_pct")
    dc = _mode_by(e, ["buyer_country"], "cpv_division_name", "dominant_cpv")
    tb = _top_by_sum(e, ["buyer_country"], "buyer_name", "awarded_eur_total", "top_buyer")
    j = sp
    for other in (cc, sv, dc, tb):
        j = j.join(other, "buyer_country", "left")
    return j.orderBy(F.col("spend_bn").desc(), "buyer_country").limit(15)
