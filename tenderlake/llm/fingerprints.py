"""I-Match document fingerprints, in DataFrame functions only.

Terms are runs of letters and digits, lower-cased.  The lexicon holds terms whose inverse
document frequency lies in a band: those in at least ``LEAST`` documents (1: no term is too rare) and at most ``MOST``
of all documents.  Document frequencies are counted over all documents by hash buckets of terms (2**BUCKET_BITS of
them), so that the lexicon is a bitmap of that many bits at any corpus size; only rare terms share a bucket
with a frequent one, and they are left out alike in every text.

A text's distinct lexicon terms are dealt to disjoint random subsets that together are the whole lexicon, and
each subset's terms are hashed: their 16-bit hashes are added up, which needs no order.  How large the subsets
are depends on the number n of terms, so that about one of a text's terms falls into each: at scale s the lexicon is
cut into 16 * 4**s subsets, and a text is fingerprinted over all of them at the smallest scale with n <= 16 * 4**s.
A fingerprint reads ``s|subset+hash ...|hash of all``; the last is I-Match's hash of all the sorted lexicon terms.
Every lexicon term of the text counts in it, so its length grows with the text's terms.
Each subset is a union of subsets of the greater scales, so the hashes of a smaller scale are sums of the
given ones.  The likeness of two fingerprints is the share of equal hashes among the subsets that either has terms
of, at the smaller of their scales.

Defined results: null text counts as empty; texts without a term have the fingerprint ``0||``, which is
like itself (1) and nothing else.  Texts none of whose terms are in the lexicon use all their terms.
Documents are ordered by (doc_id, text); a single document is followed by itself.  Rows
with a null doc_id come before all others.  Repeated rows stay; empty table: empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

BUCKET_BITS = 18
LEAST, MOST = 1, 0.1
#: Documents whose ids agree but for so many bits are ordered in one window, at most 2**ID_BITS ids.
ID_BITS = 9


def term_hashes(text: Column) -> Column:
    """Distinct hashes of the text's terms."""
    terms = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, most: float = MOST, least: int = LEAST) -> str:
    """The bitmap of the buckets in the band: 2**BUCKET_BITS bits as decimal 64-bit words."""
    n = docs.count()
    words = 1 << (BUCKET_BITS - 6)
    rows = docs.select(F.array_distinct(F.transform(
        term_hashes(F.coalesce("text", F.lit(""))), lambda h: h.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)))).alias("bs"))
    counts = rows.select(F.explode("bs").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("df"))
    inside = counts.filter(F.col("df").between(least, max(most * n, 1)))
    bits = (inside.groupBy(F.shiftright("b", 6).alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).collect())  # at most `words` rows
    found = {r["w"]: r["bits"] for r in bits}
    return ",".join(str(found.get(w, 0)) for w in range(words))


def subset_hashes(terms: Column, scale: Column) -> Column:
    """Tokens of the subsets at the scale, by subset: its number and the sum of its terms' hashes.  Terms: structs of (slot, h)."""
    parts = F.call_function("shiftleft", F.lit(16).cast("bigint"), (scale * F.lit(2)).cast("int"))
    ordered = F.sort_array(F.transform(terms, lambda x: F.struct(F.pmod(x["slot"], parts).alias("slot"), x["h"].alias("h"))))

    # A one-element array carries each intermediate value, so that it is worked out once for a row.
    def runs(x: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(x) - F.lit(1)), lambda i: (i == 0) | (x[i]["slot"] != x[i - F.lit(1)]["slot"]))
        return F.element_at(F.transform(F.array(first), lambda f: F.transform(f, lambda i, k: F.concat(
            F.lower(F.hex(x[i]["slot"])), F.lpad(F.lower(F.hex(F.aggregate(
                F.slice(x, i + F.lit(1), F.coalesce(F.get(f, k + F.lit(1)), F.size(x)) - i), F.lit(0).cast("bigint"),
                lambda acc, t: acc + t["h"]).bitwiseAND(F.lit(65535)))), 4, "0")))), 1)

    return F.element_at(F.transform(F.array(ordered), lambda x: F.when(F.size(x) > 0, runs(x)).otherwise(F.array().cast("array<string>"))), 1)


def fingerprint(hashes: Column, bitmap: str) -> Column:
    """The fingerprint of a text with these term hashes."""
    words = F.split(F.lit(bitmap), ",").cast("array<bigint>")
    bucket = (1 << BUCKET_BITS) - 1

    def inside(h: Column) -> Column:
        low = h.bitwiseAND(F.lit(bucket))
        return F.getbit(F.element_at(words, F.shiftright(low, 6).cast("int") + F.lit(1)), h.bitwiseAND(F.lit(63)).cast("int")) == 1

    def chosen(hs: Column) -> Column:
        band = F.filter(hs, inside)
        return F.when(F.size(band) > 0, band).otherwise(hs)

    def whole(terms: Column) -> Column:
        scale = F.coalesce(F.greatest(F.ceil(F.log2(F.size(terms) / F.lit(16.0)) / F.lit(2.0)), F.lit(0)).cast("int"), F.lit(0))
        dealt = F.transform(terms, lambda h: F.struct(F.shiftrightunsigned(h, 20).alias("slot"), F.shiftrightunsigned(h, 48).alias("h")))
        return F.element_at(F.transform(F.array(scale), lambda s: F.concat(
            s.cast("string"), F.lit("|"), F.array_join(subset_hashes(dealt, s), " "), F.lit("|"),
            F.when(F.size(terms) > 0, F.lower(F.hex(F.xxhash64(F.sort_array(terms))))).otherwise(F.lit("")))), 1)

    return F.element_at(F.transform(F.transform(F.array(hashes), chosen), whole), 1)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1."""
    def at(tokens: Column, scale: Column, least: Column) -> Column:
        terms = F.transform(tokens, lambda k: F.struct(
            F.conv(F.substring(k, F.lit(1), F.length(k) - F.lit(4)), 16, 10).cast("bigint").alias("slot"),
            F.conv(F.substring(k, -4, 4), 16, 10).cast("bigint").alias("h")))
        return F.when(scale == least, tokens).otherwise(subset_hashes(terms, least))

    def share(u: Column, v: Column) -> Column:
        slots = F.size(F.array_union(*(F.transform(x, lambda k: F.substring(k, F.lit(1), F.length(k) - F.lit(4))) for x in (u, v))))
        return F.when(slots == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(u, v)) / slots)

    # One-element arrays again: what both fingerprints hold is worked out once.
    def compared(x: Column, y: Column) -> Column:
        def parsed(z: Column) -> Column:
            p = F.split(z, r"\|")
            return F.struct(p[0].cast("int").alias("scale"), F.filter(F.split(p[1], " "), lambda k: k != "").alias("tokens"))

        def pair(p: Column) -> Column:
            least = F.least(p["a"]["scale"], p["b"]["scale"])
            return F.struct(at(p["a"]["tokens"], p["a"]["scale"], least).alias("u"), at(p["b"]["tokens"], p["b"]["scale"], least).alias("v"))

        both = F.array(F.struct(parsed(x).alias("a"), parsed(y).alias("b")))
        return F.element_at(F.transform(F.transform(both, pair), lambda p: share(p["u"], p["v"])), 1)

    return F.when(a == b, F.lit(1.0)).otherwise(compared(a, b)).cast("double")


def next_keys(keys: DataFrame) -> DataFrame:
    """(k, next_k): each distinct key's follower in ascending order, the first after the last."""
    ranged = written(keys.select("k").distinct().repartitionByRange("k").select("k", F.spark_partition_id().alias("part")), "ranges")
    firsts = ranged.groupBy("part").agg(F.min("k").alias("first"))  # a row for each partition
    whole = Window.orderBy("part")
    firsts = firsts.select("part", F.coalesce(
        F.lead("first").over(whole), F.first("first").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = F.lead("k").over(Window.partitionBy("part").orderBy("k"))
    return ranged.select("k", "part", inside.alias("n")).join(firsts, "part").select("k", F.coalesce("n", "after").alias("next_k"))


def edited(text: Column, n: Column, following: Column) -> Column:
    """The text with its last floor(n/2) code points replaced by the first as many of ``following``."""
    half = F.floor(n / F.lit(2)).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(following, F.lit(1), half))


def with_edits(docs: DataFrame, most: float = MOST) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    bitmap = lexicon(docs, most)
    least = F.lit(-(1 << 63)).cast("bigint")  # the place of null ids
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.shiftright(F.coalesce("doc_id", least), ID_BITS).alias("group"),
                       F.length("text").cast("bigint").alias("n_chars"))
    order = Window.partitionBy("group").orderBy("doc_id", "text")
    placed = rows.select("*", F.lead("text").over(order).alias("next_text"), F.row_number().over(order).alias("place"))

    def printed(x: DataFrame) -> DataFrame:
        """With the fingerprints of text and edited text, which are worked out behind the shuffle and kept in no table."""
        return x.select("*", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(term_hashes(F.col("text")), bitmap).alias("fingerprint"),
                        F.when(F.col("edited").isNotNull(), fingerprint(term_hashes(F.col("edited")), bitmap)).alias("edited_fingerprint"))

    every = printed(placed.withColumn("edited", edited(F.col("text"), F.col("n_chars"), F.col("next_text"))))
    every = every.withColumn("next_fingerprint", F.lead("fingerprint").over(order)).filter("next_text is not null")
    done = written(placed.filter("next_text is null or place = 1").select(
        "doc_id", "group", "n_chars", F.when(F.col("next_text").isNull(), F.col("text")).alias("tail"),
        F.when(F.col("place") == 1, F.col("text")).alias("head")), "ends")
    # The last of each group is followed by the first of the next group: one row in 2**ID_BITS where ids are dense.
    heads = done.filter("head is not null").select(F.col("group").alias("next_k"), F.col("head").alias("following"))
    after = next_keys(heads.select(F.col("next_k").alias("k"))).join(heads, "next_k").select(F.col("k").alias("group"), "following")
    ends = (done.filter("tail is not null").join(after, "group")
            .select("doc_id", "n_chars", F.col("tail").alias("text"), "following", edited(F.col("tail"), F.col("n_chars"), F.col("following")).alias("edited")))
    ends = printed(ends).withColumn("next_fingerprint", fingerprint(term_hashes(F.col("following")), bitmap))
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    every = every.select(*columns).unionByName(ends.select(*columns))
    return every.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
