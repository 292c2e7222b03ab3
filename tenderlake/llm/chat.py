r"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is rendered as ``### role: text</turn>\n``.  Inside roles and texts the
characters that control strings are made of are escaped, each by a backslash
and a letter (``\`` -> ``\b``, ``#`` -> ``\h``, ``<`` -> ``\l``, in roles also ``:``
-> ``\c``), so neither ``### `` nor ``</turn>`` can occur in an escaped text and
replacing the pairs back restores every text.

Every assistant turn becomes an example of its own: all turns before it, and its
header, are context; only the reply is trainable.  An example is its text (context, reply, what closes it) and
the span of it that lies under the loss mask.  So the examples of a conversation of n replies hold n prefixes of
its text: they are made row by row and never shuffled, but their time grows with the square of a conversation.

Defined results: null role or text counts as empty; turns are ordered by
(turn, role, text), nulls first, repeated rows stay; a null conv_id is a
conversation.  A conversation without an assistant turn has no example.
Empty table: empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
#: Turns whose text is kept in one piece while examples are put together.
BLOCK = 256


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    """A backslash in an escaped text always begins a pair, so the pairs can be
    replaced one kind after another, the backslash's own last."""
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (array of struct no, head_chars, body_chars, body_bytes,
    trainable, one for each turn in order: what stands before its text, its escaped text, whether that is a reply)."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role, ROLE_ESCAPES), F.lit(SEPARATOR))
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.transform("ts", lambda t, i: F.struct(
            i.alias("no"), F.length(t["head"]).alias("head_chars"), F.length(t["body"]).alias("body_chars"),
            F.octet_length(t["body"]).alias("body_bytes"), (t["role"] == "assistant").alias("trainable"))).alias("turns"))


def pieces_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, without what closes them."""
    pieces = F.split(formatted, "</turn>\\n")
    return F.slice(pieces, F.lit(1), F.size(pieces) - 1)


def prefix_targets(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn, an example: conv_id, example, turn (its number), formatted, context (everything before the
    reply), text (context, escaped reply and what closes it), loss_start (the context's length), loss_chars, reply (what the
    text holds under the loss mask, unescaped), and the other columns of ``formatted`` but its turns.

    Conversations without an assistant turn keep one row with a null example.
    """
    own = [c for c in formatted.columns if c not in ("formatted", "turns")]
    zipped = F.arrays_zip(pieces_of(F.col("formatted")).alias("piece"), F.col("turns").alias("at"))

    def chars(t: Column) -> Column:
        return t["head_chars"] + t["body_chars"] + F.lit(len(CLOSE))

    def total(sizes: Column) -> Column:
        return F.aggregate(sizes, F.lit(0), lambda n, x: n + x)

    def spans(ts: Column, b: Column) -> Column:
        """Where the examples of a block's turns begin: the block, the characters of it before the turn."""
        return F.transform(F.filter(ts, lambda t: t["at"]["trainable"]), lambda t: F.struct(
            t["at"].alias("at"), b.alias("block"),
            total(F.transform(F.slice(ts, F.lit(1), t["at"]["no"] % BLOCK), lambda x: chars(x["at"]))).alias("within")))

    # An example's text is put together from whole blocks of turns and one cut block: characters are counted only
    # within the cut block.  The steps are projections of their own, so that the expansion's rows
    # refer to the blocks and copies of them are made only in the texts.
    dealt = F.transform(F.sequence(F.lit(0), F.floor((F.size("zs") - 1) / BLOCK).cast("int")),
                        lambda b: F.slice("zs", b * BLOCK + 1, F.lit(BLOCK)))
    joined = F.transform("dealt", lambda ts: F.array_join(F.transform(ts, lambda x: F.concat(x["piece"], F.lit(CLOSE))), ""))
    cut = (formatted.select(*own, "formatted", zipped.alias("zs"))
           .select(*own, "formatted", dealt.alias("dealt"))
           .select(*own, "formatted", joined.alias("blocks"), F.flatten(F.transform("dealt", spans)).alias("examples"))
           .select(*own, "formatted", "blocks", F.posexplode_outer("examples").alias("example", "x")))
    at = F.col("x.at")

    def upto(n: Column) -> Column:
        """The conversation up to the first n characters of the example's block."""
        text = F.concat_ws("", F.slice("blocks", F.lit(1), F.col("x.block")),
                           F.substring(F.get("blocks", F.col("x.block")), F.lit(1), n))
        return F.when(F.col("example").isNotNull(), text)

    start = F.col("x.within") + at["head_chars"]
    rows = cut.select(*own, "example", at["no"].alias("turn"), "formatted", upto(start).alias("context"),
                      upto(start + at["body_chars"] + len(CLOSE)).alias("text"),
                      F.length(upto(start)).cast("long").alias("loss_start"),
                      at["body_chars"].cast("long").alias("loss_chars"), at["body_bytes"].alias("body_bytes"))
    # Counted in bytes from the text's end, the span under the mask is found without a walk over the context.
    held = F.substring(F.col("text").cast("binary"), F.octet_length("text") - len(CLOSE) - F.col("body_bytes") + 1, F.col("body_bytes"))
    return rows.select(*[c for c in rows.columns if c != "body_bytes"], unescape(held.cast("string")).alias("reply"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs that a formatted conversation holds."""
    def parse(piece: Column) -> Column:
        at = F.instr(piece, SEPARATOR)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(OPEN) + 1), at - F.lit(len(OPEN) + 1)), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(piece, at + F.lit(len(SEPARATOR)), F.length(piece))).alias("text"))

    return F.transform(pieces_of(formatted), parse)


def chat_digests(turns: DataFrame) -> DataFrame:
    """What the formatted output holds, read back from it, per conversation: the turns from the whole text (digested
    before the expansion, whose rows then carry digests), the loss from the text of each example under its mask."""
    formatted = format_conversations(turns)
    flat = F.array_join(F.transform("ts", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = (formatted.select("conv_id", "formatted", "turns", read_turns(F.col("formatted")).alias("ts"))
            .select("conv_id", "formatted", "turns", F.struct(
                F.size("ts").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                F.length("formatted").cast("long").alias("formatted_chars")).alias("whole")))
    replies = (prefix_targets(read).groupBy("conv_id")
               .agg(F.first("whole").alias("whole"), F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("rs")))
    loss = F.array_join(F.transform("rs", lambda r: r["reply"]), "")
    return (replies.select("conv_id", "whole.*", loss.alias("loss"))
            .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
