"""Fixed domain values.

Everything in this module is a FIXED VALUE that has to equal the surveyed
behaviour for results to match: the CPV division labels, the procurement type
spellings, the SME size words, the award result codes and the validator's
column lists.  They are listed plainly, in their natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: CPV division (first two digits) -> label -----------------
CPV_DIVISIONS: dict[str, str] = {
    "03": "Agriculture, forestry & fishing",
    "09": "Petroleum, gas & fuels",
    "14": "Mining & basic metals",
    "15": "Food, beverages & tobacco",
    "16": "Agricultural machinery",
    "18": "Clothing & textiles",
    "22": "Printed matter",
    "24": "Chemical products",
    "30": "Office & computing machinery",
    "31": "Electrical equipment",
    "32": "Communications equipment",
    "33": "Medical & laboratory equipment",
    "34": "Transport equipment",
    "35": "Security & safety equipment",
    "38": "Laboratory & optical equipment",
    "39": "Furniture",
    "42": "Industrial machinery",
    "44": "Construction materials",
    "45": "Construction works",
    "48": "Software & information systems",
    "50": "Repair & maintenance",
    "55": "Hotel & restaurant services",
    "60": "Road transport",
    "63": "Auxiliary transport services",
    "64": "Postal & telecoms",
    "65": "Public utilities",
    "66": "Financial & insurance services",
    "70": "Real estate services",
    "71": "Architectural & engineering",
    "72": "IT services",
    "73": "Research & development",
    "75": "Public administration & defence",
    "79": "Business services",
    "80": "Education & training",
    "85": "Health & social work",
    "90": "Sewage, refuse & sanitation",
    "92": "Recreational & cultural services",
    "98": "Other community services",
}

# --- FIXED VALUES: procurement type spellings (lower-case) -> label ---------
PROC_TYPE_MAP: dict[str, str] = {
    "services": "Services",
    "supplies": "Supplies",
    "works": "Works",
    "service": "Services",
    "supply": "Supplies",
}

# --- FIXED VALUES: organisation size words that count as SME ----------------
SME_VALUES: tuple[str, ...] = ("sme", "small", "medium", "true", "yes")

# --- FIXED VALUES: award result codes -> status label -----------------------
AWARDED_CODE = "selec-w"
RESULT_STATUSES: dict[str, str] = {
    "selec-w": "Awarded",
    "clos-nw": "Closed without winner",
    "open-nw": "Open without winner",
    "unpublished": "Unpublished",
}

# --- FIXED VALUES: natural keys of the eight silver tables ------------------
NATURAL_KEYS: dict[str, list[str]] = {
    "notices": ["notice_id"],
    "lots": ["notice_id", "lot_id"],
    "organisations": ["notice_id", "org_id"],
    "cpv_codes": ["notice_id", "cpv_code"],
    "lot_results": ["notice_id", "lot_result_id"],
    "contracts": ["notice_id", "lot_result_id", "contract_id"],
    "tendering_parties": ["notice_id", "party_id"],
    "tenders": ["notice_id", "tender_id"],
}

# --- FIXED VALUES: numeric columns that add/subtract to the dedupe score -----
QUALITY_VALUE_COLUMNS: tuple[str, ...] = (
    "estimated",
    "total_awarded",
    "lot_est",
    "duration_val",
    "awarded_amount",
    "contract_value",
    "tender_value",
    "subcontracting",
)

# Date columns that break dedupe ties, in priority order.  The first three are
# the surveyed ones; lot_date is the lots view's own date column.
DEDUPE_DATE_COLUMNS: tuple[str, ...] = ("pub_date", "contract_date", "submission_deadline", "lot_date")

# --- FIXED VALUES: expected silver schemas (validator) -----------------------
EXPECTED_SCHEMAS: dict[str, list[str]] = {
    "notices": ["notice_id", "notice_type", "pub_date", "buyer_org_id", "buyer_name", "buyer_country",
                "project_title", "proc_type", "procedure_type", "cpv_main", "cpv_division",
                "cpv_division_name", "estimated", "estimated_value", "est_currency", "total_awarded",
                "submission_deadline", "framework", "source_file"],
    "lots": ["notice_id", "lot_id", "lot_title", "lot_desc", "lot_est", "lot_currency", "duration_val",
             "duration_unit", "duration_months", "award_criteria"],
    "organisations": ["notice_id", "org_id", "org_name", "org_country", "org_role", "sme", "is_sme",
                      "nuts_code"],
    "cpv_codes": ["notice_id", "cpv_code", "cpv_division", "cpv_division_name"],
    "lot_results": ["notice_id", "lot_result_id", "lot_id", "result_code", "awarded_amount",
                    "award_currency", "tenders_count", "sme_tenders", "winner_tender_id", "winner_org_id",
                    "is_awarded", "result_status"],
    "contracts": ["notice_id", "lot_result_id", "contract_id", "contract_date", "contract_value",
                  "contract_currency"],
    "tendering_parties": ["notice_id", "party_id", "tender_ids", "num_tenders"],
    "tenders": ["notice_id", "tender_id", "lot_id", "tendering_party_id", "tender_value",
                "tender_currency", "rank", "is_ranked", "subcontracting"],
}

OPTIONAL_COLUMNS: dict[str, list[str]] = {
    "tendering_parties": ["tenderer_id", "tenderer_ids", "is_lead", "num_tenderers"],
    "tenders": ["bid_amount"],
}

CRITICAL_COLUMNS: dict[str, list[str]] = {
    "notices": ["notice_id", "notice_type", "pub_date", "project_title", "source_file"],
    "lots": ["notice_id", "lot_id"],
    "organisations": ["notice_id", "org_id", "org_name", "org_country"],
    "cpv_codes": ["notice_id", "cpv_code"],
    "lot_results": ["notice_id", "lot_result_id", "lot_id"],
    "contracts": ["notice_id", "lot_result_id", "contract_id"],
    "tendering_parties": ["notice_id", "party_id"],
    "tenders": ["notice_id", "tender_id", "lot_id", "tendering_party_id"],
}

# (label, table, column) of the fields the models need.
IMPORTANT_ML_FIELDS: list[tuple[str, str, str]] = [
    ("winner_org_id", "lot_results", "winner_org_id"),
    ("tenders_count", "lot_results", "tenders_count"),
    ("tenderer_id", "tendering_parties", "tenderer_id"),
    ("awarded_amount", "lot_results", "awarded_amount"),
    ("estimated_value", "notices", "estimated_value"),
    ("contract_value", "contracts", "contract_value"),
    ("contract_date", "contracts", "contract_date"),
    ("bid_amount", "tenders", "bid_amount"),
    ("tender_value", "tenders", "tender_value"),
]

# Contract-value ceiling used by the value / competition studies.
VALUE_CAP = 5_000_000_000.0
# Country excluded in the "ex-HUN" variants.
EXCLUDED_COUNTRY = "HUN"


# --- FIXED VALUES: contract size tiers (edges 50k / 500k / 5M) ---------------
# Labels of the value study:
SIZE_TIER_LABELS_EURO: tuple[str, ...] = ("Micro (<€50K)", "Small (€50K–500K)", "Mid (€500K–5M)", "Large (>€5M)")
# Plain labels of the competition / opportunity studies (same edges):
SIZE_TIER_LABELS_PLAIN: tuple[str, ...] = ("Micro (<50K)", "Small (50K-500K)", "Mid (500K-5M)", "Large (>5M)")
SIZE_TIER_EDGES: tuple[float, ...] = (50_000.0, 500_000.0, 5_000_000.0)

# --- FIXED VALUES: bidder brackets, left-closed [lo, hi) ---------------------
BIDDER_BRACKETS: tuple[tuple[str, float, float], ...] = (
    ("1 bidder (no competition)", 1.0, 1.5),
    ("2-3 bidders (low)", 1.5, 3.5),
    ("4-5 bidders (medium)", 3.5, 5.5),
    ("6-10 bidders (high)", 5.5, 10.5),
    (">10 bidders (very high)", 10.5, float("inf")),
)

# --- FIXED VALUES: savings-by-competition brackets, right-closed (lo, hi] ----
SAVINGS_BRACKETS: tuple[tuple[str, float, float], ...] = (
    ("1 bidder", 0.0, 1.5),
    ("2-3", 1.5, 3.5),
    ("4-5", 3.5, 5.5),
    ("6-10", 5.5, 10.5),
    (">10", 10.5, float("inf")),
)

# --- FIXED VALUES: market competition tiers on median bidders, (lo, hi] ------
MARKET_TIERS: tuple[tuple[str, float, float], ...] = (
    ("Low competition", 0.0, 2.0),
    ("Medium competition", 2.0, 4.0),
    ("High competition", 4.0, float("inf")),
)


# --- FIXED VALUES: columns of the gold marts, in their order -----------------
GOLD_COLUMNS: dict[str, tuple[str, ...]] = {
    "gold_notices": (
        "notice_id", "notice_type", "pub_date", "submission_deadline", "buyer_org_id", "buyer_name",
        "buyer_country", "project_title", "proc_type", "procedure_type", "cpv_code", "cpv_main", "cpv_codes",
        "cpv_division", "cpv_division_name", "estimated", "total_awarded", "lot_count", "lot_estimated_total",
        "avg_lot_duration", "result_count", "awarded_lot_count", "awarded_amount", "contract_count",
        "contract_value", "first_contract_date", "tender_count", "tendering_party_count", "avg_tenders_count",
        "tender_value", "framework", "source_file"),
    "gold_lots": (
        "notice_id", "lot_id", "notice_type", "pub_date", "buyer_name", "buyer_country", "project_title",
        "lot_title", "lot_desc", "proc_type", "procedure_type", "cpv_code", "cpv_division", "cpv_division_name",
        "estimated", "lot_est", "lot_currency", "duration_val", "duration_unit", "award_criteria", "result_code",
        "is_awarded", "winner_org_id", "tenders_count", "awarded_amount", "contract_value", "contract_date",
        "contract_count", "tender_count", "tender_value", "avg_tender_value", "lot_result_count"),
    "gold_awards": (
        "notice_id", "lot_id", "lot_result_id", "notice_type", "pub_date", "buyer_name", "buyer_country",
        "project_title", "lot_title", "proc_type", "procedure_type", "cpv_code", "cpv_division",
        "cpv_division_name", "result_code", "is_awarded", "winner_org_id", "winner_name", "winner_country",
        "is_sme", "tenders_count", "sme_tenders", "awarded_amount", "award_currency", "contract_value",
        "contract_date", "contract_count", "tender_value", "tender_currency", "estimated", "total_awarded",
        "lot_est", "lot_currency"),
    "gold_opportunities": (
        "notice_id", "pub_date", "buyer_name", "buyer_country", "buyer_org_id", "project_title",
        "proc_type", "procedure_type", "cpv_main", "cpv_division", "cpv_division_name", "estimated",
        "num_lots", "avg_lot_duration", "submission_deadline", "framework", "source_file"),
    "gold_notice_awards": (
        "notice_id", "pub_date", "buyer_name", "buyer_country", "buyer_org_id", "project_title",
        "proc_type", "cpv_main", "cpv_division", "cpv_division_name", "estimated", "awarded_eur",
        "savings_pct", "num_lots", "num_awarded_lots", "avg_tenders_per_lot", "total_tenders",
        "winner_names", "winner_countries", "sme_winner", "avg_lot_duration", "source_file"),
}
#: Columns of a notice that lots and awards carry.
NOTICE_COLUMNS_OF_LOTS: tuple[str, ...] = (
    "notice_id", "notice_type", "pub_date", "buyer_name", "buyer_country", "project_title",
    "proc_type", "procedure_type", "cpv_code", "cpv_division", "cpv_division_name", "estimated")
