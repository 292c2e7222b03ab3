"""Raw (bronze) tables -> typed, de-duplicated silver tables.

Each transform is a pure ``DataFrame -> DataFrame`` function.  Missing columns
are added as typed NULLs (``conform``) so downstream projections never fail on
schema drift.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C
from ..functions.lookups import DEDUPE_DATE_COLUMNS, NATURAL_KEYS, QUALITY_VALUE_COLUMNS, SME_VALUES

# Declared silver projections (name, type) in output order.
SILVER_SCHEMAS: dict[str, list[tuple[str, str]]] = {
    "notices": [("notice_id", "string"), ("notice_type", "string"), ("pub_date", "string"),
                ("buyer_org_id", "string"), ("buyer_name", "string"), ("buyer_country", "string"),
                ("project_title", "string"), ("proc_type", "string"), ("procedure_type", "string"),
                ("cpv_main", "string"), ("cpv_division", "string"), ("cpv_division_name", "string"),
                ("estimated", "double"), ("estimated_value", "double"), ("est_currency", "string"),
                ("total_awarded", "double"), ("submission_deadline", "string"), ("framework", "string"),
                ("source_file", "string")],
}


def conform(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Project ``schema`` in order; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in schema])


def with_null_columns(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Add each absent column as a typed NULL (keeps present ones)."""
    missing = {n: F.lit(None).cast(t) for n, t in cols.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


# --------------------------------------------------------------------------- #
# Quality-scored de-duplication
# --------------------------------------------------------------------------- #

def quality_score(df: DataFrame, value_cols=QUALITY_VALUE_COLUMNS) -> Column:
    """Non-null columns, +3 per valid non-negative value column, -3 per negative."""
    parts = [F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in df.columns]
    for c in value_cols:
        if c in df.columns:
            v = C.to_double(c)
            parts.append(F.when(v >= 0, 3).when(v < 0, -3).otherwise(0))
    return reduce(lambda a, b: a + b, parts)


def rank_struct(df: DataFrame, key: list[str], value_cols=QUALITY_VALUE_COLUMNS, date_cols=DEDUPE_DATE_COLUMNS,
                order_cols: list[str] | None = None, null_date_wins: bool = False) -> Column:
    """What rows of one key are compared by: higher score wins; then each date column in priority order,
    later wins and a real date beats a NULL one (``null_date_wins=True`` reproduces the surveyed behaviour
    where NULL sorts last and so wins); then ``order_cols`` (default: a ``source_order`` column if present,
    else every non-key column), larger wins."""
    cols = df.columns
    if order_cols is None:
        order_cols = ["source_order"] if "source_order" in cols else [c for c in cols if c not in key]
    rank_parts: list[Column] = [quality_score(df, value_cols).alias("_score")]
    for i, d in enumerate([d for d in date_cols if d in cols]):
        ts = F.col(d).try_cast("timestamp")
        rank_parts.append((ts.isNull() if null_date_wins else ts.isNotNull()).alias(f"_dn{i}"))
        rank_parts.append(ts.alias(f"_d{i}"))
    rank_parts += [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)]
    return F.struct(*rank_parts)


#: Before the names of a row's columns in what stands for it among the rows of its key.
CARRIED = "c_"


def ranked_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """(key..., _best): each row as what it is compared by, then its other columns, each value once (see
    :func:`dedupe_quality`).  The largest of a key can be merged over parts of the rows, so it is the key's whole state."""
    compared, carried = compared_and_carried(df, key)
    return df.select(*key, F.struct(*compared, *[F.col(c).alias(f"{CARRIED}{c}") for c in carried]).alias("_best"))


def compared_and_carried(df: DataFrame, key: list[str], value_cols=QUALITY_VALUE_COLUMNS, date_cols=DEDUPE_DATE_COLUMNS,
                         order_cols: list[str] | None = None, null_date_wins: bool = False) -> tuple[list[Column], list[str]]:
    """(score and dates as compared, the columns that follow them in a row's struct: order columns, then the others)."""
    cols = df.columns
    if order_cols is None:
        order_cols = ["source_order"] if "source_order" in cols else [c for c in cols if c not in key]
    compared = [quality_score(df, value_cols).alias("_score")]
    for i, d in enumerate([d for d in date_cols if d in cols]):
        ts = F.col(d).try_cast("timestamp")
        # NULL is the smallest value of a struct field; a flag is needed only where it has to be the largest.
        compared += [ts.isNull().alias(f"_dn{i}")] if null_date_wins else []
        compared.append(ts.alias(f"_d{i}"))
    # A row is one value, so what stands after the order columns is decided with them.
    return compared, [*order_cols, *[c for c in cols if c not in key and c not in order_cols]]


def dedupe_quality(df: DataFrame, key: list[str], value_cols=QUALITY_VALUE_COLUMNS,
                   date_cols=DEDUPE_DATE_COLUMNS, order_cols: list[str] | None = None,
                   null_date_wins: bool = False) -> DataFrame:
    """Keep one row per natural ``key``: the best by (quality score, dates, source order), see :func:`rank_struct`.

    Implemented as ``groupBy(key).agg(max(row))`` rather than a
    ``row_number`` window: the aggregate combines map-side, so a hot key that
    holds a large share of rows is reduced to one row per input partition
    before the shuffle instead of being sorted in a single task.
    The rank's own fields are read back as the row's columns, so a value is shipped once: a row holds
    (score, dates as compared, then the order columns and the remaining columns), and the largest is kept.
    """
    cols = df.columns
    compared, carried = compared_and_carried(df, key, value_cols, date_cols, order_cols, null_date_wins)
    row = F.struct(*compared, *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carried)])
    best = df.groupBy(*key).agg(F.max(row).alias("_best"))
    field = {c: f"_best._c{i}" for i, c in enumerate(carried)}
    return best.select(*[F.col(c) if c in key else F.col(field[c]).alias(c) for c in cols])


def duplicate_stats(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key occurs more than once (keep=False semantics) and rows removed."""
    g = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
                 F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed_rows"))


# --------------------------------------------------------------------------- #
# Per-table transforms
# --------------------------------------------------------------------------- #

def transform_notices(df: DataFrame, date_prefix: str | None = None) -> DataFrame:
    df = with_null_columns(df, {"estimated_value": "string", "total_awarded": "string"})
    out = df.withColumns({
        "pub_date": C.clean_date("publication_date"),
        "estimated": C.to_double("est_amount"),
        "total_awarded": C.to_double("total_awarded"),
        "cpv_division": C.cpv_division("cpv_main"),
        "proc_type": C.normalise_proc_type("proc_type"),
    })
    out = out.withColumns({
        "estimated_value": F.coalesce(C.to_double("estimated_value"), F.col("estimated")),
        "cpv_division_name": C.cpv_division_name("cpv_division"),
    })
    out = C.date_prefix_filter(out, "pub_date", date_prefix)
    return conform(out, SILVER_SCHEMAS["notices"])


def transform_lots(df: DataFrame) -> DataFrame:
    return df.withColumns({"lot_est": C.to_double("lot_est"), "duration_val": C.to_double("duration_val")})


def transform_organisations(df: DataFrame, sme_values: tuple[str, ...] = SME_VALUES) -> DataFrame:
    return df.withColumn("is_sme", C.sme_flag("sme", sme_values))


def transform_lot_results(df: DataFrame) -> DataFrame:
    df = with_null_columns(df, {"sme_tenders": "string", "winner_tender_id": "string",
                                "award_currency": "string"})
    return df.withColumns({
        "awarded_amount": C.to_double("awarded_amount"),
        "tenders_count": C.to_int("tenders_count"),
        "sme_tenders": C.to_int("sme_tenders"),
        "is_awarded": C.awarded_flag("result_code"),
        "result_status": C.result_status("result_code"),
    })


def transform_tenders(df: DataFrame) -> DataFrame:
    df = with_null_columns(df, {"bid_amount": "string", "subcontracting": "string", "tender_currency": "string"})
    return df.withColumns({
        "tender_value": C.to_double("tender_value"),
        "subcontracting": F.col("subcontracting").cast("string"),
        "subcontracting_pct": C.to_double("subcontracting"),
    }).withColumn("bid_amount", F.coalesce(C.to_double("bid_amount"), F.col("tender_value")))


def transform_contracts(df: DataFrame) -> DataFrame:
    v = C.to_double("contract_value")
    return df.withColumns({
        "contract_value_raw": v,
        "contract_value_was_negative_source": F.coalesce(v < 0, F.lit(False)),
        "contract_value": F.when(~(v < 0) | v.isNull(), v),
        "contract_date": C.clean_date("contract_date"),
    }).select("notice_id", "lot_result_id", "contract_id", "contract_value", "contract_date",
              "contract_value_raw", "contract_value_was_negative_source")


def transform_cpv_codes(df: DataFrame) -> DataFrame:
    div = C.cpv_division("cpv_code")
    return df.withColumns({"cpv_division": div, "cpv_division_name": C.cpv_division_name(div)})


def transform_tendering_parties(df: DataFrame) -> DataFrame:
    df = with_null_columns(df, {"tenderer_id": "string"})
    return df.withColumn("tenderer_id", F.coalesce(F.col("tenderer_id"), F.col("party_id")))


TRANSFORMS = {
    "notices": transform_notices,
    "lots": transform_lots,
    "organisations": transform_organisations,
    "lot_results": transform_lot_results,
    "tenders": transform_tenders,
    "contracts": transform_contracts,
    "cpv_codes": transform_cpv_codes,
    "tendering_parties": transform_tendering_parties,
}


def silver_table(raw: DataFrame, table: str) -> DataFrame:
    """Transform then de-duplicate on the table's natural key."""
    return dedupe_quality(TRANSFORMS[table](raw), NATURAL_KEYS[table])


# --------------------------------------------------------------------------- #
# Buyer enrichment
# --------------------------------------------------------------------------- #

def enrich_buyers(notices: DataFrame, organisations: DataFrame) -> DataFrame:
    """Fill buyer name / country from the notice's own organisation rows.

    Left join on (notice_id, buyer_org_id = org_id); the org key is null-safe
    so a NULL buyer id matches a NULL org id as the surveyed merge does.
    ``organisations`` must already be unique on (notice_id, org_id).
    """
    orgs = organisations.select(F.col("notice_id").alias("_o_notice"), F.col("org_id").alias("_o_org"),
                                F.col("org_name").alias("_o_name"), F.col("org_country").alias("_o_country"))
    j = notices.join(orgs, (notices.notice_id == orgs._o_notice) & notices.buyer_org_id.eqNullSafe(orgs._o_org),
                     "left")
    cols = [F.coalesce(F.col("buyer_name"), F.col("_o_name")).alias("buyer_name") if c == "buyer_name" else
            F.coalesce(F.col("buyer_country"), F.col("_o_country")).alias("buyer_country") if c == "buyer_country"
            else F.col(c) for c in notices.columns]
    return j.select(*cols)


def enrich_fill_counts(notices: DataFrame, enriched: DataFrame) -> DataFrame:
    """How many buyer names / countries the enrichment filled."""
    before = notices.agg(F.count("buyer_name").alias("n0"), F.count("buyer_country").alias("c0"))
    after = enriched.agg(F.count("buyer_name").alias("n1"), F.count("buyer_country").alias("c1"))
    return after.select((F.col("n1") - F.lit(before.select("n0").scalar())).alias("buyer_name_filled"),
                        (F.col("c1") - F.lit(before.select("c0").scalar())).alias("buyer_country_filled"))
