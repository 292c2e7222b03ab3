"""Procurement-shaped views over the driver tables.

The surveyed pipeline starts from eight relational tables extracted from
notice XML.  The driver ships TPC-H-like tables instead, so these views present
them in the raw (pre-silver) procurement shapes.  Null spellings, zone-suffixed
dates, duplicate keys, negative values and mixed-case codes are injected by
deterministic rules on the keys, so the cleaning operators have real work.

Every view is a plain DataFrame plan: joins are on equality keys and Catalyst
decides the physical strategy (the 25-row nation table is auto-broadcast by
size; orders x customer and lineitem x part are sort-merge joins at scale).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import read_table


def _s(c: str):
    return F.col(c).cast("string")


def _date_str(c: str):
    return F.col(c).cast("date").cast("string")


def src_notices(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    return j.select(
        _s("o_orderkey").alias("notice_id"),
        F.when(F.col("o_orderstatus") == "F", "CAN").when(F.col("o_orderstatus") == "O", "CN")
        .otherwise("PIN").alias("notice_type"),
        F.concat(_date_str("o_orderdate"), F.when(k % 3 == 0, "Z").otherwise("+01:00")).alias("publication_date"),
        _s("c_custkey").alias("buyer_org_id"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("buyer_name"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("n_name")).alias("buyer_country"),
        F.concat(F.lit("contract "), _s("o_orderkey")).alias("project_title"),
        F.when(F.col("c_mktsegment") == "BUILDING", "works").when(F.col("c_mktsegment") == "MACHINERY", "supply")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "SUPPLIES").when(F.col("c_mktsegment") == "HOUSEHOLD", "services")
        .otherwise("combined").alias("proc_type"),
        F.col("o_orderpriority").alias("procedure_type"),
        F.concat((F.lit(30) + F.col("c_custkey") % 50).cast("string"), F.lit("000000")).alias("cpv_main"),
        F.when(k % 4 == 0, None).when(k % 101 == 0, "n/a").otherwise(_s("o_totalprice")).alias("est_amount"),
    )


def src_lot_results(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_partkey",
                    "l_quantity", "l_suppkey", "l_extendedprice", "l_discount")
    return li.select(
        _s("l_orderkey").alias("notice_id"),
        F.concat(F.lit("RES-"), _s("l_linenumber")).alias("lot_result_id"),
        F.concat(F.lit("LOT-"), _s("l_linenumber")).alias("lot_id"),
        F.when(F.col("l_returnflag") == "R", "selec-w").when(F.col("l_returnflag") == "A", "clos-nw")
        .otherwise("open-nw").alias("result_code"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity").cast("int") % 12).alias("tenders_count"),
        _s("l_suppkey").alias("winner_org_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("awarded_amount"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("TEN-"), _s("l_suppkey"), F.lit("-"), _s("l_partkey")))
        .alias("winner_tender_id"),
    )


def src_contracts(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                    "l_discount", "l_shipdate", "l_linestatus")
    return li.where(F.col("l_linestatus") == "F").select(
        _s("l_orderkey").alias("notice_id"),
        F.concat(F.lit("RES-"), _s("l_linenumber")).alias("lot_result_id"),
        F.concat(F.lit("CON-"), _s("l_partkey")).alias("contract_id"),
        F.when(F.col("l_partkey") % 97 == 0, -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("contract_value"),
        F.concat(_date_str("l_shipdate"), F.lit("Z")).alias("contract_date"),
    )


def src_tenders(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber",
                    "l_extendedprice", "l_quantity", "l_returnflag", "l_shipdate")
    return li.select(
        _s("l_orderkey").alias("notice_id"),
        F.concat(F.lit("TEN-"), _s("l_suppkey"), F.lit("-"), _s("l_partkey")).alias("tender_id"),
        F.concat(F.lit("LOT-"), (F.col("l_linenumber") % 2).cast("string")).alias("lot_id"),
        _s("l_suppkey").alias("tendering_party_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("tender_value"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("is_ranked"),
        F.col("l_linenumber").alias("rank"),
        F.col("l_shipdate").alias("bid_date"),
    )


def src_organisations(spark, sf_dir) -> DataFrame:
    """Buyers (one per notice) then suppliers (distinct per notice).

    ``source_order`` records which branch a row came from (0 buyers, 1
    suppliers), i.e. the row order of the concatenation; it breaks dedupe ties.
    """
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    buyers = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(_s("o_orderkey").alias("notice_id"), _s("c_custkey").alias("org_id"),
                      F.col("c_name").alias("org_name"), F.col("n_name").alias("org_country"),
                      F.when(F.col("c_acctbal") < 0, "micro").when(F.col("c_acctbal") < 3000, "small")
                      .when(F.col("c_acctbal") < 6000, "Medium").otherwise("large").alias("sme"),
                      F.lit(0).alias("source_order")))
    # Different pairs of keys meet different suppliers, so the rows are distinct before they are as wide as they get.
    suppliers = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
                 .select("s_suppkey", F.col("s_name").alias("org_name"), F.col("n_name").alias("org_country"),
                         F.when(F.col("s_acctbal") < 3000, "small").otherwise("large").alias("sme"))
                 .distinct())
    pairs = li.select("l_orderkey", "l_suppkey").distinct()
    sellers = (pairs.join(suppliers, pairs.l_suppkey == suppliers.s_suppkey)
               .select(_s("l_orderkey").alias("notice_id"), _s("s_suppkey").alias("org_id"),
                       "org_name", "org_country", "sme", F.lit(1).alias("source_order")))
    return buyers.unionByName(sellers)


def src_cpv_codes(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        _s("l_orderkey").alias("notice_id"),
        F.concat((F.lit(30) + F.col("p_size")).cast("string"),
                 F.when(F.col("p_partkey") % 50 == 0, "00").otherwise("000000")).alias("cpv_code"),
    )


def src_lots(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey",
                    "l_quantity", "l_shipdate")
    return li.select(
        _s("l_orderkey").alias("notice_id"),
        F.concat(F.lit("LOT-"), _s("l_linenumber")).alias("lot_id"),
        F.col("l_extendedprice").alias("lot_est"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("l_quantity")).alias("duration_val"),
        F.col("l_shipdate").alias("lot_date"),
        F.col("l_partkey").alias("source_order"),
    )


def src_tendering_parties(spark, sf_dir) -> DataFrame:
    """One row per (notice, party): its tender ids, sorted and ', '-joined."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_partkey")
    tid = F.concat(F.lit("TEN-"), _s("l_suppkey"), F.lit("-"), _s("l_partkey"))
    return (li.groupBy("l_orderkey", "l_suppkey")
            .agg(F.array_join(F.sort_array(F.collect_list(tid)), ", ").alias("tender_ids"),
                 F.count(F.lit(1)).alias("num_tenders"))
            .select(_s("l_orderkey").alias("notice_id"), _s("l_suppkey").alias("party_id"),
                    "tender_ids", "num_tenders"))


def src_events(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ev.withColumn("event_date", F.col("ts").cast("date"))


def src_titles(spark, sf_dir) -> DataFrame:
    """Text classification input: whole document text as the title, the
    language as its class and the quality label where one exists."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    return (d.join(lab, "doc_id", "left")
            .select("doc_id", F.col("text").alias("project_title"), F.col("lang").alias("cpv_division"),
                    F.col("quality").alias("quality_label")))


SRC_VIEWS = {
    "notices": src_notices,
    "lots": src_lots,
    "organisations": src_organisations,
    "cpv_codes": src_cpv_codes,
    "lot_results": src_lot_results,
    "contracts": src_contracts,
    "tendering_parties": src_tendering_parties,
    "tenders": src_tenders,
    "events": src_events,
    "titles": src_titles,
}
