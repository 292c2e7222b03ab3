"""Notice XML: render eForms-shaped documents and parse them into the eight
bronze tables.

Parsing: ``from_xml`` with ``ignoreNamespace`` (prefixed eForms and unprefixed
documents read alike) in PERMISSIVE mode, so a malformed document yields a NULL
struct (quarantined) instead of failing the job.  The root element's local
name gives the notice type.  Every element of the schema is an array, so a
repeated element keeps all its occurrences in document order; a value is the first non-empty
one along its path.  Header paths that may stand on the notice, on a lot or in an extension list these
places in the order of the notice format (notice, then its lots; extension, then its contracts).
Award data come from the first extension that has the eForms block, organisations from all.

Rendering: ``notice_documents`` builds one document per order from the driver
tables, text by text (lines become lots, results, tenders and contracts), so
the parser can be exercised at table scale; per-order arrays are bounded by the
lines of one order.  Rules on the keys add what real notices have: repeated names,
extensions, criteria and statistics, several tender references, values on lots or contracts
only, namespace prefixes, and broken files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import read_table

# FIXED VALUES: root element local names -> notice type.
ROOT_TYPES = {"ContractNotice": "CN", "ContractAwardNotice": "CAN", "PriorInformationNotice": "PIN"}

TEXT = "ARRAY<STRING>"

_BLOCK = "UBLExtensions.UBLExtension.ExtensionContent.EformsExtension"
_AMOUNT = "RequestedTenderTotal.EstimatedOverallContractAmount"
_TENDERS = tuple(f"{_BLOCK}.NoticeResult.LotTender.{p}" for p in (
    "ID", "RankCode", "TenderRankedIndicator", "LegalMonetaryTotal.PayableAmount._VALUE",
    "LegalMonetaryTotal.PayableAmount._currencyID", "TenderingParty.ID", "TenderLot.ID", "SubcontractingTerm.TermCode"))
_RESULTS = tuple(f"{_BLOCK}.NoticeResult.LotResult.{p}" for p in (
    "ID", "TenderResultCode", "TenderLot.ID", "LotTender.ID", "SettledContract.ID",
    "ReceivedSubmissionsStatistics.StatisticsCode", "ReceivedSubmissionsStatistics.StatisticsNumeric"))
_CONTRACTS = tuple(f"{_BLOCK}.NoticeResult.SettledContract.{p}" for p in ("ID", "IssueDate", "LotTender.ID"))
#: The paths that each flattener reads, besides the notice's ID.
PATHS = {
    "notices": (
        "IssueDate", *(f"ContractingParty.Party.{p}" for p in (
            "PartyIdentification.ID", "PartyName.Name", "PostalAddress.Country.IdentificationCode")),
        *(f"{at}.{p}" for at in ("ProcurementProject", "ProcurementProjectLot.ProcurementProject") for p in (
            "Name", "ProcurementTypeCode", "MainCommodityClassification.ItemClassificationCode",
            f"{_AMOUNT}._VALUE", f"{_AMOUNT}._currencyID")),
        *(f"{at}.{p}" for at in ("TenderingProcess", "ProcurementProjectLot.TenderingProcess")
          for p in ("ProcedureCode", "TenderSubmissionDeadlinePeriod.EndDate")),
        f"{_BLOCK}.ContractFrameworkIndicator", f"{_BLOCK}.NoticeResult.TotalAmount",
        f"{_BLOCK}.NoticeResult.SettledContract.ContractFrameworkIndicator"),
    "cpv_codes": tuple(f"{at}.AdditionalCommodityClassification.ItemClassificationCode"
                       for at in ("ProcurementProject", "ProcurementProjectLot.ProcurementProject")),
    "lots": tuple(f"ProcurementProjectLot.{p}" for p in (
        "ID", *(f"ProcurementProject.{p}" for p in (
            "Name", "Description", f"{_AMOUNT}._VALUE", f"{_AMOUNT}._currencyID",
            "PlannedPeriod.DurationMeasure._VALUE", "PlannedPeriod.DurationMeasure._unitCode")),
        "TenderingTerms.AwardingTerms.AwardingCriterion.SubordinateAwardingCriterion.AwardingCriterionTypeCode")),
    "organisations": tuple(f"{_BLOCK}.Organizations.Organization.Company.{p}" for p in (
        "PartyIdentification.ID", "PartyName.Name", "PostalAddress.Country.IdentificationCode",
        "PostalAddress.CountrySubentityCode", "CompanySizeCode")),
    "lot_results": (*_RESULTS, *_TENDERS),
    "contracts": (*_RESULTS, *_TENDERS, *_CONTRACTS),
    "tenders": _TENDERS,
    "tendering_parties": _TENDERS,
}


def notice_schema(*tables: str) -> str:
    """The schema of a notice as far as the flatteners of these tables read it.  Every element may repeat; a
    leaf that begins with _ is an attribute of its element (_VALUE: its text)."""
    tree: dict = {"ID": {}}
    for path in (p for t in tables for p in PATHS[t]):
        at = tree
        for name in path.split("."):
            at = at.setdefault(name, {})

    def fields(node: dict, sep: str) -> str:
        return ", ".join(f"{name}{sep}{kind(name, below)}" for name, below in node.items())

    def kind(name: str, below: dict) -> str:
        return f"ARRAY<STRUCT<{fields(below, ': ')}>>" if below else "STRING" if name.startswith("_") else TEXT

    return f"{fields(tree, ' ')}, _corrupt_record STRING"


NOTICE_SCHEMA = notice_schema(*PATHS)


XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def txt(c: Column) -> Column:
    """Element text, stripped; empty -> NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def nodes(at: Column, *path: str) -> Column:
    """All elements at ``path`` below the elements ``at``, in document order."""
    def child(name: str):
        return lambda x: F.coalesce(x[name], F.array())

    for name in path:
        at = F.flatten(F.transform(F.coalesce(at, F.array()), child(name)))
    return at


def below(x: Column, *path: str) -> Column:
    """All elements at ``path`` below one element."""
    return nodes(F.coalesce(x[path[0]], F.array()), *path[1:])


def first(*found: Column) -> Column:
    """The first non-empty text of the elements found, place after place."""
    return F.coalesce(*[F.try_element_at(F.filter(F.transform(f, txt), lambda t: t.isNotNull()), F.lit(1)) for f in found])


def first_with(attribute: str, *found: Column) -> tuple[Column, Column]:
    """(text, attribute) of the first element found that has a text."""
    hit = F.coalesce(*[F.try_element_at(F.filter(f, lambda x: txt(x["_VALUE"]).isNotNull()), F.lit(1)) for f in found])
    return txt(hit["_VALUE"]), txt(hit[attribute])


# --------------------------------------------------------------------------- #
# Reading and parsing
# --------------------------------------------------------------------------- #

def read_xml_files(spark, path: str) -> DataFrame:
    """Every ``*.xml`` file under ``path`` (recursively) as (file_name, xml)."""
    return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml")
            .text(path, wholetext=True)
            .select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("xml")))


def parse_all(docs: DataFrame, schema: str = NOTICE_SCHEMA) -> DataFrame:
    """(file_name, root_tag, n): every document parsed once; n is null or has a
    ``_corrupt_record`` where that failed.  All leaves are texts, so a narrower ``schema`` finds the same documents
    well-formed, at the cost of the elements it names.  The generator keeps the planner from
    evaluating ``from_xml`` and the tag again for each use above it, and conditions on them from moving below."""
    # Only what stands before the root can hide it; a DOCTYPE may stand between comments, so there all of them go.
    aside = r"(?:<\?.*?\?>|<!--.*?-->)"
    shown = (F.when(F.contains("xml", F.lit("<!DOCTYPE")), F.regexp_replace("xml", f"(?s){aside}", ""))
             .when(F.col("xml").rlike(r"\A[^<]*+<[?!]"), F.regexp_replace("xml", rf"(?s)\A(?:[^<]*+{aside})++", ""))
             .otherwise(F.col("xml")))
    root = F.regexp_extract(shown, r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)[\s>/]", 1)
    parsed = F.struct(root.alias("root_tag"), F.from_xml("xml", schema, XML_OPTIONS).alias("n"))
    return docs.select("file_name", F.explode(F.array(parsed)).alias("p")).select("file_name", "p.root_tag", "p.n")


def _well_formed() -> Column:
    return F.col("n").isNotNull() & F.col("n._corrupt_record").isNull() & (F.col("root_tag") != "")


def well_formed(parsed: DataFrame) -> DataFrame:
    """(file_name, notice_id, notice_type, n) of the documents that parsed; the
    file's stem stands in for a missing notice id."""
    mapping = F.create_map(*[F.lit(x) for kv in ROOT_TYPES.items() for x in kv])
    stem = F.regexp_extract("file_name", r"^(.*)\.xml$", 1)
    return parsed.where(_well_formed()).select(
        "file_name", F.coalesce(first(F.col("n.ID")), F.nullif(stem, F.lit(""))).alias("notice_id"),
        F.coalesce(F.try_element_at(mapping, F.col("root_tag")), F.col("root_tag")).alias("notice_type"), "n")


def malformed(parsed: DataFrame) -> DataFrame:
    """Files of the documents that did not parse."""
    return parsed.where(~F.coalesce(_well_formed(), F.lit(False))).select("file_name")


def parse_notices(docs: DataFrame) -> DataFrame:
    """(file_name, xml) -> one parsed row per well-formed document."""
    return well_formed(parse_all(docs))


def quarantine(docs: DataFrame) -> DataFrame:
    """(file_name, xml) -> file_name of the documents that did not parse."""
    return malformed(parse_all(docs))


def _extensions() -> Column:
    return nodes(F.col("n.UBLExtensions"), "UBLExtension", "ExtensionContent", "EformsExtension")


def _results_block(*path: str) -> Column:
    """Elements below the notice results of the first eForms block."""
    return nodes(F.slice(_extensions(), 1, 1), "NoticeResult", *path)


def bronze_notices(p: DataFrame) -> DataFrame:
    party = nodes(F.col("n.ContractingParty"), "Party")

    def project(*path: str) -> tuple[Column, Column]:
        """On the notice's project, then on its lots' projects."""
        return nodes(F.col("n.ProcurementProject"), *path), nodes(F.col("n.ProcurementProjectLot"), "ProcurementProject", *path)

    def process(*path: str) -> tuple[Column, Column]:
        return nodes(F.col("n.TenderingProcess"), *path), nodes(F.col("n.ProcurementProjectLot"), "TenderingProcess", *path)

    amount, currency = first_with("_currencyID", *project("RequestedTenderTotal", "EstimatedOverallContractAmount"))
    blocks = _extensions()
    return p.select(
        "notice_id", "notice_type", first(F.col("n.IssueDate")).alias("publication_date"),
        first(nodes(party, "PartyIdentification", "ID")).alias("buyer_org_id"),
        first(nodes(party, "PartyName", "Name")).alias("buyer_name"),
        first(nodes(party, "PostalAddress", "Country", "IdentificationCode")).alias("buyer_country"),
        first(*project("Name")).alias("project_title"),
        first(*project("ProcurementTypeCode")).alias("proc_type"),
        first(*process("ProcedureCode")).alias("procedure_type"),
        first(*project("MainCommodityClassification", "ItemClassificationCode")).alias("cpv_main"),
        amount.alias("est_amount"), currency.alias("est_currency"),
        first(nodes(F.slice(nodes(blocks, "NoticeResult"), 1, 1), "TotalAmount")).alias("total_awarded"),
        first(*process("TenderSubmissionDeadlinePeriod", "EndDate")).alias("submission_deadline"),
        first(nodes(blocks, "ContractFrameworkIndicator"),
              nodes(blocks, "NoticeResult", "SettledContract", "ContractFrameworkIndicator")).alias("framework"),
        F.col("file_name").alias("source_file"))


def bronze_cpv_codes(p: DataFrame) -> DataFrame:
    """Additional codes of the notice and of its lots."""
    path = "AdditionalCommodityClassification", "ItemClassificationCode"
    codes = F.concat(nodes(F.col("n.ProcurementProject"), *path), nodes(F.col("n.ProcurementProjectLot"), "ProcurementProject", *path))
    return p.select("notice_id", F.explode(codes).alias("c")).select("notice_id", txt(F.col("c")).alias("cpv_code"))


def bronze_lots(p: DataFrame) -> DataFrame:
    lot = F.col("l")
    amount, currency = first_with("_currencyID", below(lot, "ProcurementProject", "RequestedTenderTotal", "EstimatedOverallContractAmount"))
    duration, unit = first_with("_unitCode", below(lot, "ProcurementProject", "PlannedPeriod", "DurationMeasure"))
    return p.select("notice_id", F.explode("n.ProcurementProjectLot").alias("l")).select(
        "notice_id", first(lot["ID"]).alias("lot_id"), first(below(lot, "ProcurementProject", "Name")).alias("lot_title"),
        first(below(lot, "ProcurementProject", "Description")).alias("lot_desc"), amount.alias("lot_est"),
        currency.alias("lot_currency"), duration.alias("duration_val"), unit.alias("duration_unit"),
        first(below(lot, "TenderingTerms", "AwardingTerms", "AwardingCriterion", "SubordinateAwardingCriterion",
                    "AwardingCriterionTypeCode")).alias("award_criteria"))


def bronze_organisations(p: DataFrame) -> DataFrame:
    o = F.col("o")
    return p.select("notice_id", F.explode(nodes(_extensions(), "Organizations", "Organization")).alias("o")).select(
        "notice_id", first(below(o, "Company", "PartyIdentification", "ID")).alias("org_id"),
        first(below(o, "Company", "PartyName", "Name")).alias("org_name"),
        first(below(o, "Company", "PostalAddress", "Country", "IdentificationCode")).alias("org_country"),
        first(below(o, "Company", "CompanySizeCode")).alias("sme"),
        first(below(o, "Company", "PostalAddress", "CountrySubentityCode")).alias("nuts_code"))


def _tenders_raw(p: DataFrame) -> DataFrame:
    """Every LotTender with its position in the document."""
    t = F.col("t")
    value, currency = first_with("_currencyID", below(t, "LegalMonetaryTotal", "PayableAmount"))
    return p.select("notice_id", F.posexplode(_results_block("LotTender")).alias("pos", "t")).select(
        "notice_id", "pos", first(t["ID"]).alias("tender_id"), first(below(t, "TenderLot", "ID")).alias("lot_id"),
        first(below(t, "TenderingParty", "ID")).alias("tendering_party_id"),
        value.alias("tender_value"), currency.alias("tender_currency"),
        first(t["RankCode"]).alias("rank"), first(t["TenderRankedIndicator"]).alias("is_ranked"),
        first(below(t, "SubcontractingTerm", "TermCode")).alias("subcontracting"))


def bronze_tenders(p: DataFrame) -> DataFrame:
    return _tenders_raw(p).drop("pos")


def _tender_lookup(p: DataFrame) -> DataFrame:
    """tender id -> its element; a repeated id resolves to the last one in the document."""
    t = _tenders_raw(p).where(F.col("tender_id").isNotNull())
    return (t.groupBy("notice_id", "tender_id")
            .agg(F.max_by(F.struct("tender_value", "tender_currency", "tendering_party_id", "rank", "is_ranked"),
                          F.col("pos")).alias("t"))
            .select("notice_id", "tender_id", "t.*"))


def _results(p: DataFrame) -> DataFrame:
    r = F.col("r")
    return p.select("notice_id", F.posexplode(_results_block("LotResult")).alias("rpos", "r")).select(
        "notice_id", "rpos", first(r["ID"]).alias("lot_result_id"), first(below(r, "TenderLot", "ID")).alias("lot_id"),
        first(r["TenderResultCode"]).alias("result_code"), r["ReceivedSubmissionsStatistics"].alias("stats"),
        r["LotTender"].alias("refs"), r["SettledContract"].alias("contract_refs"))


def lot_result_stats(p: DataFrame) -> DataFrame:
    """Statistics array pivoted: the last 'tenders' / 't-sme' entry wins."""
    def last_of(code: str) -> Column:
        hits = F.filter(F.coalesce("stats", F.array()), lambda s: first(s["StatisticsCode"]) == code)
        return first(F.try_element_at(hits, F.lit(-1))["StatisticsNumeric"])
    return _results(p).select("notice_id", "rpos", "lot_result_id", last_of("tenders").alias("tenders_count"),
                              last_of("t-sme").alias("sme_tenders"))


def lot_winner(p: DataFrame) -> DataFrame:
    """Winner per result: follow its tender refs in order; the first whose tender
    has rank '1' or a true ranked indicator wins; take its value, currency, party."""
    refs = (_results(p).select("notice_id", "rpos", F.posexplode("refs").alias("ref_pos", "ref"))
            .select("notice_id", "rpos", "ref_pos", first(F.col("ref.ID")).alias("tender_id")))
    cand = refs.join(_tender_lookup(p), ["notice_id", "tender_id"]).where(
        (F.col("rank") == "1") | (F.lower(F.col("is_ranked")) == "true"))
    return (cand.groupBy("notice_id", "rpos")
            .agg(F.min_by(F.struct("tender_id", "tendering_party_id", "tender_value", "tender_currency"),
                          F.col("ref_pos")).alias("w"))
            .select("notice_id", "rpos", F.col("w.tender_id").alias("winner_tender_id"),
                    F.col("w.tendering_party_id").alias("winner_org_id"),
                    F.col("w.tender_value").alias("awarded_amount"), F.col("w.tender_currency").alias("award_currency")))


def bronze_lot_results(p: DataFrame) -> DataFrame:
    res = _results(p).select("notice_id", "rpos", "lot_result_id", "lot_id", "result_code")
    return (res.join(lot_result_stats(p).drop("lot_result_id"), ["notice_id", "rpos"], "left")
            .join(lot_winner(p), ["notice_id", "rpos"], "left")
            .select("notice_id", "lot_result_id", "lot_id", "result_code", "tenders_count", "sme_tenders",
                    "winner_tender_id", "winner_org_id", "awarded_amount", "award_currency"))


def bronze_contracts(p: DataFrame) -> DataFrame:
    """Result -> settled-contract ref -> contract detail (last with that id) ->
    linked tender (last with that id) -> value and currency."""
    refs = (_results(p).select("notice_id", "lot_result_id", F.explode("contract_refs").alias("c"))
            .select("notice_id", "lot_result_id", first(F.col("c.ID")).alias("contract_id")))
    sc = (p.select("notice_id", F.posexplode(_results_block("SettledContract")).alias("pos", "s"))
          .select("notice_id", "pos", first(F.col("s.ID")).alias("contract_id"),
                  first(F.col("s.IssueDate")).alias("contract_date"), first(below(F.col("s"), "LotTender", "ID")).alias("tender_id"))
          .where(F.col("contract_id").isNotNull())
          .groupBy("notice_id", "contract_id")
          .agg(F.max_by(F.struct("contract_date", "tender_id"), F.col("pos")).alias("d"))
          .select("notice_id", "contract_id", "d.*"))
    tl = _tender_lookup(p).select("notice_id", "tender_id", "tender_value", "tender_currency")
    j = refs.join(sc, ["notice_id", "contract_id"], "left").join(tl, ["notice_id", "tender_id"], "left")
    return j.select("notice_id", "lot_result_id", "contract_id", F.col("tender_value").alias("contract_value"),
                    F.col("tender_currency").alias("contract_currency"), "contract_date")


def tendering_parties(p: DataFrame) -> DataFrame:
    """Tenders grouped by party reference: ', '-joined tender ids (document order) and count."""
    t = _tenders_raw(p).where(F.col("tendering_party_id").isNotNull())
    g = t.groupBy("notice_id", "tendering_party_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("tender_id", F.lit(""))
                                              .alias("tid")))).alias("_t"))
    return g.select("notice_id", F.col("tendering_party_id").alias("party_id"),
                    F.array_join(F.transform("_t", lambda x: x["tid"]), ", ").alias("tender_ids"),
                    F.size("_t").cast("bigint").alias("num_tenders"))


BRONZE = {
    "notices": bronze_notices, "cpv_codes": bronze_cpv_codes, "lots": bronze_lots,
    "organisations": bronze_organisations, "lot_results": bronze_lot_results, "contracts": bronze_contracts,
    "tenders": bronze_tenders, "tendering_parties": tendering_parties,
}


# --------------------------------------------------------------------------- #
# Rendering documents from the driver tables
# --------------------------------------------------------------------------- #

def _escaped(texts: Column) -> Column:
    """An array of texts, null ones as empty, as the XML writer escapes them.  Plain texts stay as they are; if one is
    not, they all go through the writer, which escapes the brackets that its own elements have."""
    whole = F.transform(texts, lambda t: F.coalesce(t, F.lit("")))
    written = F.to_xml(F.struct(whole.alias("v")), {"rowTag": "t"})
    inner = F.regexp_extract(written, r"(?s)\A<t>\n    <v>(.*)</v>\n</t>\n?\z", 1)
    return F.when(F.array_join(whole, "").rlike(r"\A[ -%'-;=?-~]*+\z"), whole).otherwise(F.split(inner, r"</v>\n    <v>", -1))


def _text(parts: list) -> Column:
    """Parts of a document one after the other: literals, of which neighbours become one, and columns that are not null."""
    merged: list = []
    for x in parts:
        if isinstance(x, str) and merged and isinstance(merged[-1], str):
            merged[-1] += x
        else:
            merged.append(x)
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in merged])


def _line(depth: int, tag: str) -> str:
    return f"\n{'    ' * depth}<{tag}>"


def _leaf(depth: int, tag: str, value: Column, attribute: str = "") -> list:
    """An element with a text, on a line of its own."""
    return [f"{_line(depth, tag + attribute)}", value, f"</{tag}>"]


def _optional(parts: list) -> list:
    """Parts of which one column may be null: then none of them is there."""
    return [F.coalesce(_text(parts), F.lit(""))]


def _when(condition: Column, parts: list, otherwise: list | None = None) -> list:
    return [F.when(condition, _text(parts)).otherwise(_text(otherwise) if otherwise else F.lit(""))]


def _within(depth: int, tags: str, *children: list) -> list:
    """Elements around each other, the first at ``depth``, around children of which some are there."""
    names = list(enumerate(tags.split("."), depth))
    return [*[_line(i, t) for i, t in names], *[x for c in children for x in c], *[_line(i, f"/{t}") for i, t in reversed(names)]]


def _holder(depth: int, tags: str, child: list) -> list:
    """Elements around one child with a column that may be null: then the innermost is empty."""
    *outer, last = tags.split(".")
    at = depth + len(outer)
    own = [F.coalesce(_text(_within(at, last, child)), F.lit(_line(at, f"{last}/")))]
    return _within(depth, ".".join(outer), own) if outer else own


def _amount(depth: int, tag: str, v: Column) -> list:
    return _leaf(depth, tag, v.cast("string"), ' currencyID="EUR"')


def _each(items: Column, render) -> list:
    """The rendered items of an array; nothing without an array."""
    return [F.coalesce(F.array_join(F.transform(items, render), ""), F.lit(""))]


def notice_documents(spark, sf_dir: str) -> DataFrame:
    """One eForms-shaped XML document per order (file_name, xml)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    sn = n.select(F.col("n_nationkey").alias("s_nat"), F.col("n_name").alias("s_nation"))
    lines = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).join(
        sn, F.col("s_nationkey") == F.col("s_nat"))
    won = F.col("l_returnflag") == "R"
    settled = F.col("l_linestatus") == "F"
    has = F.col("l_partkey") % 9

    def counted(modulus: int) -> Column:
        return (F.col("l_quantity").cast("int") % modulus).cast("string")

    # A line travels as narrow texts, in the order that sorts the lines of a notice; its elements are made of
    # them where the notice is.
    line = F.struct(
        F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.when(F.col("l_partkey") % 13 != 0, F.struct(F.col("l_quantity").cast("string").alias("q"))).alias("days"),
        F.concat((F.lit(30) + F.col("p_size")).cast("string"),
                 F.when(F.col("p_partkey") % 50 == 0, "00").otherwise("000000")).alias("cpv"),
        F.when(won, "selec-w").when(F.col("l_returnflag") == "A", "clos-nw").otherwise("open-nw").alias("code"),
        F.when(has == 3, F.array(counted(12), counted(5), counted(7))).when(has != 0, F.array(counted(12))).alias("counts"),
        F.when(settled, True).alias("settled"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("string").alias("paid"),
        F.when(settled, F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("Z"))).alias("issued"),
        F.col("s_name").alias("name"), F.col("s_nation").alias("nation"),
        F.when(F.col("s_acctbal") < 3000, "small").otherwise("large").alias("size"))

    def tid(x: Column) -> Column:
        return F.concat(F.lit("TEN-"), x["sk"].cast("string"), F.lit("-"), x["pk"].cast("string"))

    def lot_id(x: Column) -> Column:
        return F.concat(F.lit("LOT-"), x["ln"].cast("string"))

    def contract_id(x: Column) -> Column:
        return F.concat(F.lit("CON-"), x["pk"].cast("string"))

    def company(key: Column, name: Column, nation: Column, size: Column) -> list:
        """``name`` and ``nation`` as they are shown."""
        return _within(6, "Organization.Company", _within(8, "PartyIdentification", _leaf(9, "ID", key.cast("string"))),
                       _holder(8, "PartyName", _leaf(9, "Name", name)),
                       _holder(8, "PostalAddress.Country", _leaf(10, "IdentificationCode", nation)),
                       _leaf(8, "CompanySizeCode", size))

    # lines of one order: bounded by the order's line count
    per_order = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    hdr = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    d = hdr.join(per_order, hdr.o_orderkey == per_order.l_orderkey, "left")
    k = F.col("o_orderkey")
    all_lines = F.col("lines")
    on_lots = k % 6 == 1  # kind and codes stand on the lots only
    kind = (F.when(F.col("c_mktsegment") == "BUILDING", "works").when(F.col("c_mktsegment") == "MACHINERY", "supply")
            .when(F.col("c_mktsegment") == "AUTOMOBILE", "SUPPLIES").when(F.col("c_mktsegment") == "HOUSEHOLD", "services")
            .otherwise("combined"))
    cpv_main = F.concat((F.lit(30) + F.col("c_custkey") % 50).cast("string"), F.lit("000000"))

    def kind_and_code(depth: int) -> list:
        return [*_leaf(depth, "ProcurementTypeCode", kind),
                *_within(depth, "MainCommodityClassification", _leaf(depth + 1, "ItemClassificationCode", cpv_main))]

    def code(depth: int, x: Column) -> list:
        return _holder(depth, "AdditionalCommodityClassification", _leaf(depth + 1, "ItemClassificationCode", x["cpv"]))

    def lot(x: Column) -> Column:
        days = x["days"]["q"]
        duration = [F.coalesce(_text(_leaf(4, "DurationMeasure", days, ' unitCode="DAY"')), F.lit(_line(4, 'DurationMeasure unitCode="DAY"/')))]

        def criterion(name: str) -> list:
            return _within(4, "AwardingCriterion.SubordinateAwardingCriterion", _leaf(6, "AwardingCriterionTypeCode", F.lit(name)))

        return _text(_within(1, "ProcurementProjectLot", _optional(_leaf(2, "ID", lot_id(x))), _within(
            2, "ProcurementProject", _when(on_lots, [F.col("kind_and_code"), *code(3, x)]),
            _holder(3, "RequestedTenderTotal", _amount(4, "EstimatedOverallContractAmount", x["price"])),
            _when(x["days"].isNotNull(), _within(3, "PlannedPeriod", duration))),
            _within(2, "TenderingTerms.AwardingTerms", _when(x["pk"] % 3 == 0, criterion("price")), criterion("quality"))))

    def statistic(v: Column, i: Column) -> Column:
        codes = F.array(F.lit("tenders"), F.lit("t-sme"), F.lit("tenders"))
        return _text(_within(7, "ReceivedSubmissionsStatistics", _leaf(8, "StatisticsCode", F.get(codes, i)),
                             _optional(_leaf(8, "StatisticsNumeric", v))))

    def result(x: Column, i: Column) -> Column:
        """Some results name the next line's tender before their own."""
        following = tid(F.try_element_at(all_lines, (i + F.lit(2)).cast("int")))
        return _text(_within(
            6, "LotResult", _optional(_leaf(7, "ID", F.concat(F.lit("RES-"), x["ln"].cast("string")))),
            _leaf(7, "TenderResultCode", x["code"]), _holder(7, "TenderLot", _leaf(8, "ID", lot_id(x))), _each(x["counts"], statistic),
            _when(x["pk"] % 4 == 1, _optional(_within(7, "LotTender", _leaf(8, "ID", following)))),
            _within(7, "LotTender", _leaf(8, "ID", tid(x))),
            _when(x["settled"], _within(7, "SettledContract", _leaf(8, "ID", contract_id(x))))))

    def tender(x: Column) -> Column:
        won = x["code"] == "selec-w"
        return _text(_within(
            6, "LotTender", _leaf(7, "ID", tid(x)),
            _when(won, [*_leaf(7, "RankCode", F.lit("1")), *_leaf(7, "TenderRankedIndicator", F.lit("true"))], _leaf(7, "RankCode", F.lit("2"))),
            _holder(7, "LegalMonetaryTotal", _amount(8, "PayableAmount", x["paid"])),
            _within(7, "TenderingParty", _leaf(8, "ID", x["sk"].cast("string"))), _holder(7, "TenderLot", _leaf(8, "ID", lot_id(x)))))

    def contract(x: Column) -> Column:
        return _when(x["settled"], _within(
            6, "SettledContract", _leaf(7, "ID", contract_id(x)), _optional(_leaf(7, "IssueDate", x["issued"])),
            _leaf(7, "ContractFrameworkIndicator", (x["pk"] % 4 == 0).cast("string")), _within(7, "LotTender", _leaf(8, "ID", tid(x)))))[0]

    # The texts of a document that may need escapes: of its header, then the names and the nations of its lines.
    header = ("c_name", "n_name", "o_orderpriority")
    texts = F.concat(F.array(*header), *[F.coalesce(f"lines.{f}", F.array().cast("array<string>")) for f in ("name", "nation")])

    def shown(text: Column, at: Column) -> Column:
        return F.when(text.isNotNull(), F.get("shown", at))

    def of_header(name: str) -> Column:
        return shown(F.col(name), F.lit(header.index(name)))

    def seller(x: Column) -> Column:
        return _text(company(x["sk"], x["name"], x["nation"], x["size"]))

    sellers = F.array_distinct(F.transform(all_lines, lambda x, i: F.struct(
        x["sk"].alias("sk"), shown(x["name"], i + F.lit(len(header))).alias("name"),
        shown(x["nation"], i + F.size(all_lines) + F.lit(len(header))).alias("nation"), x["size"].alias("size"))))
    buyer_size = (F.when(F.col("c_acctbal") < 0, "micro").when(F.col("c_acctbal") < 3000, "small")
                  .when(F.col("c_acctbal") < 6000, "Medium").otherwise("large"))
    root = (F.when(F.col("o_orderstatus") == "F", "ContractAwardNotice")
            .when(F.col("o_orderstatus") == "O", "ContractNotice").otherwise("PriorInformationNotice"))
    shown_name, shown_nation = of_header("c_name"), of_header("n_name")
    document = ["<", F.col("root"), ">", *_leaf(1, "ID", k.cast("string")), *_optional(_leaf(1, "IssueDate", F.concat(
        F.col("o_orderdate").cast("date").cast("string"), F.when(k % 3 == 0, "Z").otherwise("+01:00")))),
        *_within(1, "ContractingParty.Party", _within(3, "PartyIdentification", _leaf(4, "ID", F.col("c_custkey").cast("string"))),
                 _holder(3, "PartyName", _leaf(4, "Name", F.when(F.col("c_custkey") % 5 != 0, shown_name))),
                 _when(F.col("c_custkey") % 3 == 0, _holder(3, "PartyName", _leaf(4, "Name", F.concat(F.lit("trading "), shown_name)))),
                 _holder(3, "PostalAddress.Country", _leaf(5, "IdentificationCode", F.when(F.col("c_custkey") % 7 != 0, shown_nation)))),
        *_within(1, "ProcurementProject", _leaf(2, "Name", F.concat(F.lit("contract "), k.cast("string"))),
                 _when(~on_lots, [*kind_and_code(2), *_each(all_lines, lambda x: _text(code(2, x)))]),
                 _holder(2, "RequestedTenderTotal", _amount(3, "EstimatedOverallContractAmount", F.when(k % 4 != 0, F.col("o_totalprice"))))),
        *_holder(1, "TenderingProcess", _leaf(2, "ProcedureCode", of_header("o_orderpriority"))),
        *_each(all_lines, lot),
        *_within(1, "UBLExtensions", _when(k % 2 == 0, [_line(2, "UBLExtension/")]), _within(
            2, "UBLExtension.ExtensionContent.EformsExtension",
            _within(5, "Organizations", company(F.col("c_custkey"), shown_name, shown_nation, buyer_size), _each(sellers, seller)),
            _when(all_lines.isNotNull(), _within(5, "NoticeResult", *[_each(all_lines, part) for part in (result, tender, contract)]),
                  [_line(5, "NoticeResult/")]))),
        "\n</", F.col("root"), ">"]
    # Texts are put together as the XML writer indents and escapes them (tested against it).  Each step is a projection of
    # its own, read more than once above: a document is rendered once, and only the documents that get prefixes pay for them.
    made = (d.select("*", k.alias("k"), root.alias("root"), _text(kind_and_code(3)).alias("kind_and_code"), _escaped(texts).alias("shown"))
            .select("k", "root", _text(document).alias("named")))
    # Prefixed elements, as real notices have them.
    prefixed = F.regexp_replace(F.regexp_replace("named", r"<(/?)([A-Z])", "<$1cac:$2"), F.concat(F.lit("^<cac:"), F.col("root")),
                                F.concat(F.lit("<cac:"), F.col("root"), F.lit(' xmlns:cac="urn:notice"')))
    xml = F.when(F.col("k") % 101 == 0, F.expr("left(named, length(named) - 20)")).when(F.col("k") % 10 == 3, prefixed).otherwise(F.col("named"))
    return made.select(F.concat(F.col("k").cast("string"), F.lit(".xml")).alias("file_name"), F.explode(F.array(xml)).alias("xml"))
