"""Bronze XML parser on hand-made, namespaced eForms fixtures."""

from __future__ import annotations

import hashlib
import os

from tenderlake.context import Lake
from tenderlake.plans import xml_queries
from tenderlake.sources import xml_notices as X

FIX = os.path.join(os.path.dirname(__file__), "fixtures", "xml")


def _parsed(spark):
    return X.parse_notices(X.read_xml_files(spark, FIX))


def test_notice_types_ids_and_quarantine(spark):
    docs = X.read_xml_files(spark, FIX)
    p = {r.file_name: r for r in X.parse_notices(docs).collect()}
    assert p["can_two_lots.xml"].notice_type == "CAN" and p["can_two_lots.xml"].notice_id == "can-0001"
    assert p["cn_minimal.xml"].notice_type == "CN"                       # prefixed root element
    assert p["pin.xml"].notice_type == "PIN"
    assert p["unknown_root.xml"].notice_type == "BusinessRegistrationInformationNotice"
    assert p["empty_text.xml"].notice_id == "empty_text"                 # file-stem fallback
    assert "malformed.xml" not in p
    assert [r.file_name for r in X.quarantine(docs).collect()] == ["malformed.xml"]


def test_header_empty_text_is_null(spark):
    n = {r.notice_id: r for r in X.bronze_notices(_parsed(spark)).collect()}
    assert n["empty_text"].project_title is None and n["empty_text"].est_amount is None
    assert n["cn-0001"].est_amount == "80000" and n["cn-0001"].est_currency == "EUR"
    assert n["can-0001"].est_amount == "110000"                           # first lot's estimate
    assert n["can-0001"].total_awarded == "150000" and n["can-0001"].source_file == "can_two_lots.xml"


def test_award_flatteners(spark):
    p = _parsed(spark)
    lots = X.bronze_lots(p).where("notice_id = 'can-0001'").orderBy("lot_id").collect()
    assert [(r.lot_id, r.lot_est, r.duration_val, r.duration_unit) for r in lots] == [
        ("LOT-0001", "110000", "6", "MONTH"), ("LOT-0002", None, None, None)]
    res = {r.lot_result_id: r for r in X.bronze_lot_results(p).collect()}
    assert (res["RES-1"].winner_tender_id, res["RES-1"].winner_org_id, res["RES-1"].awarded_amount) == (
        "TEN-1", "TPA-1", "100000")                                       # first ref with rank 1
    assert (res["RES-1"].tenders_count, res["RES-1"].sme_tenders) == ("2", "1")
    assert res["RES-2"].winner_tender_id == "TEN-3"                       # ranked indicator
    c = X.bronze_contracts(p).collect()
    assert [(r.contract_id, r.contract_value, r.contract_date) for r in c] == [("CON-1", "100000", "2026-01-20+01:00")]
    parties = {r.party_id: r for r in X.tendering_parties(p).collect()}
    assert parties["TPA-1"].tender_ids == "TEN-1, TEN-3" and parties["TPA-1"].num_tenders == 2
    orgs = X.bronze_organisations(p).where("notice_id <> 'rep-0001'").orderBy("org_id").collect()
    assert [(o.org_id, o.org_country, o.sme, o.nuts_code) for o in orgs] == [
        ("ORG-1", "DEU", None, "DE300"), ("ORG-2", None, "small", None)]
    assert sorted(r.cpv_code for r in X.bronze_cpv_codes(p).where("notice_id <> 'rep-0001'").collect()) == ["45000000", "71000000"]


def test_repeated_and_nested_elements(spark):
    p = _parsed(spark).where("notice_id = 'rep-0001'")
    n = X.bronze_notices(p).first()
    assert (n.buyer_org_id, n.project_title, n.total_awarded, n.framework) == ("B1", "first title", "5", "true")
    assert (n.proc_type, n.cpv_main) == ("works", "45000000")
    assert [r.cpv_code for r in X.bronze_cpv_codes(p).collect()] == ["71000000"]
    assert [r.award_criteria for r in X.bronze_lots(p).collect()] == ["price"]
    assert [(r.org_id, r.org_name) for r in X.bronze_organisations(p).collect()] == [("ORG-1", "First")]
    assert [r.winner_tender_id for r in X.bronze_lot_results(p).collect()] == ["T2"]


def test_documents_are_parsed_once(spark):
    docs = X.read_xml_files(spark, FIX)
    plan = X.bronze_notices(X.parse_notices(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") + plan.count("xmltostructs") + plan.count("XmlToStructs") <= 2  # one node, named and aliased


def test_xml_folder_to_gold(spark):
    from tenderlake.context import Lake
    lake = Lake.from_xml(spark, FIX)
    gold = {r.notice_id: r for r in lake.gold("gold_notices").collect()}
    assert gold["rep-0001"].cpv_division == "45" and gold["can-0001"].lot_count == 2
    assert lake.quarantine().count() == 1
    lake.close()


def test_root_is_found_behind_what_may_stand_before_it(spark):
    """Comments and instructions before the root may hold tags; the text of a document is not searched for them."""
    body = "<{0}><ID>1</ID><!-- <x> --></{0}>"
    before = ["", "﻿", "  \n", "<?xml version='1.0'?>\n", "<!-- <A> -->", "<?xml version='1.0'?><!-- <A b='1'> -->\n<?p <B> ?>",
              "<!-- <A> --><!DOCTYPE ContractNotice [<!ELEMENT ID ANY>]><!-- <B> -->"]
    docs = spark.createDataFrame([(f"{i}.xml", b + body.format("cac:ContractNotice")) for i, b in enumerate(before)], "file_name string, xml string")
    tags = {r.file_name: r.root_tag for r in X.parse_all(docs).collect()}
    assert tags == {f"{i}.xml": "ContractNotice" for i in range(len(before))}
    plan = X.parse_all(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "DOCTYPE" in plan  # the whole text is stripped only where a DOCTYPE makes that necessary


def test_a_notice_is_rendered_once_and_prefixed_only_where_it_has_prefixes(spark):
    """The prefixes are put on in the projection that chooses among the renderings, not for every document."""
    plan = X.notice_documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_xml(") == 1
    line = next(x for x in plan.splitlines() if "cac:" in x)
    assert "CASE WHEN" in line and "to_xml(" not in line


def test_a_narrow_schema_reads_what_the_whole_one_does(spark):
    """Each flattener over documents parsed as far as it reads them gives what it gives over whole ones."""
    docs = X.read_xml_files(spark, FIX)
    broken = spark.createDataFrame([("cut.xml", "<ContractNotice><ID>1</ID><Issue"), ("none.xml", ""), ("bare.xml", "<ContractNotice/>")],
                                   "file_name string, xml string")
    docs = docs.unionByName(broken)
    whole = X.parse_notices(docs)
    for name, flatten in X.BRONZE.items():
        a, b = flatten(whole), flatten(X.well_formed(X.parse_all(docs, X.notice_schema(name))))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    kept = [sorted(r.file_name for r in X.malformed(X.parse_all(docs, x)).collect()) for x in (X.NOTICE_SCHEMA, X.notice_schema())]
    assert kept[0] == kept[1] and "cut.xml" in kept[0]


def test_single_pass_flatteners_render_once_and_write_nothing(spark):
    """A flattener that reads the notices once gets them as they are parsed, and conditions on them don't render them again."""
    lake = Lake(spark, "/root/testdata/sf0.001", materialize=True)
    for name in ("bronze_xml_parse", "bronze_notices", "bronze_lots", "bronze_cpv_codes", "bronze_organisations", "bronze_tenders"):
        plan = getattr(xml_queries, name)(lake)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("to_xml(") == 1, name
    assert "bronze_parsed" not in lake._cache


def test_documents_are_put_together_as_the_xml_writer_would(spark, tmp_path):
    """Names with signs to escape, missing values, orders without lines: the writer's documents, without a struct for each."""
    names = ["a&b", "<x>", "]]>", "tab\there", "cr\rx", "nl\nx", "", " lead ", "é 漢 😀", "\"q\" 'a'", "a>b", "$1 \\ x", None, "plain"]
    at = str(tmp_path)
    day = "timestamp'1998-02-03'"
    spark.createDataFrame([(i, x, i % 3, 100.0 * i - 50, "BUILDING") for i, x in enumerate(names)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(i, x, i % 3, 2900.0 + 20 * i) for i, x in enumerate(names)],
                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{at}/supplier.parquet")
    spark.createDataFrame([(0, "N&A"), (1, None), (2, "NATION")], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(i, None if i == 3 else i) for i in range(14)], "p_partkey long, p_size int").write.parquet(f"{at}/part.parquet")
    spark.range(102).selectExpr(
        "id as o_orderkey", "id % 14 as o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 as int)) as o_orderstatus",
        "if(id % 5 = 0, null, id * 1.5D) as o_totalprice", f"if(id % 7 = 0, null, {day}) as o_orderdate",
        "if(id % 2 = 0, '1-URG<', null) as o_orderpriority").write.parquet(f"{at}/orders.parquet")
    spark.range(300).where("id % 102 <> 5").selectExpr(
        "id % 102 as l_orderkey", "id % 14 as l_partkey", "id * 5 % 14 as l_suppkey", "if(id % 11 = 0, null, cast(id % 4 as int)) as l_linenumber",
        "if(id % 6 = 0, null, id + 1.0D) as l_quantity", "if(id % 10 = 0, null, id * 2.5D) as l_extendedprice", "0.1D as l_discount",
        "element_at(array('R', 'A', 'N'), cast(id % 3 + 1 as int)) as l_returnflag", "if(id % 2 = 0, 'F', 'O') as l_linestatus",
        f"if(id % 9 = 0, null, {day}) as l_shipdate").write.parquet(f"{at}/lineitem.parquet")
    docs = X.notice_documents(spark, at)
    assert "NOTICE_ROOT" not in docs._jdf.queryExecution().optimizedPlan().toString()
    found = docs.orderBy("file_name").collect()
    assert len(found) == 102
    text = "".join(f"{r.file_name}\n{r.xml}\n" for r in found)
    assert hashlib.md5(text.encode()).hexdigest() == "ea1860179d06f918dfb2dd682cc91e65"  # of the documents that to_xml wrote
