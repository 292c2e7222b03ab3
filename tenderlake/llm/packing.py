"""Packing into fixed-length sequences: shortest-pack-first over the length histogram.

1. Each document becomes token ids and an end id; what exceeds a sequence is cut
   into full pieces and a rest.  A task numbers its pieces of each length.
2. The histogram of lengths (at most ``capacity`` rows, so a bounded collect)
   is packed on the driver: lengths are placed longest first, all pieces of a length at
   once, into the pattern with the most room; a pattern is an open kind of
   pack with a count, and splits when only some of its packs take another piece.
3. The patterns say which ranks of each length go to which packs and where.
   A piece's rank within its length is its number in its task plus what earlier tasks hold
   (a window over one row per task and length); the join by length and rank range
   then gives each piece its sequence and offset.  The pattern table does
   not grow with the documents (a few slots for each length), and is broadcast.

Sequences hold whole pieces without gaps, from offset 0.  A sequence is padded
to ``capacity`` unless its length is a power of two.

Defined results: null text counts as empty; an empty text is one piece, the end id.
Long texts give any number of full pieces.  Repeated rows (also with one doc_id) are
packed each for itself.  Empty table: empty result.  Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import keep_only, map_columns, written

CAPACITY = 1024
END_ID = 0


class PieceTokenizer:
    """ids by a byte-level BPE file of the tokenizers library, without a cache: memory doesn't grow with the words met.

    The file's merges are run by tiktoken, several times as fast as the library itself.  Both give the same ids when
    merge i makes token 256 + i (then the merge that comes first is the one of the smallest new id) and every token
    is what the merges make of its own bytes (then any two neighbours that spell a token are a listed
    merge).  The first is checked here, the second and equal ids for every code point are tested for the public file.
    """

    #: How byte-level BPE cuts a text, without backtracking.  Fixed value.
    PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers
        stated = json.loads(Tokenizer.from_file(path).to_str())
        model, vocab = stated["model"], stated["model"]["vocab"]
        added = {t["content"]: t["id"] for t in stated["added_tokens"]}
        plain = all(not t[k] for t in stated["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        cut = stated["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or stated["normalizer"]
                or not plain or any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges))):
            raise ValueError(f"{path} is not a byte-level BPE whose ids follow its merges")
        # Byte-level files write printable Latin-1 bytes as themselves, the others as the characters from U+0100, in order.
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        others = iter(sorted(c for c in alphabet if ord(c) > 255))
        byte_of = {chr(b) if chr(b) in alphabet else next(others): b for b in range(256)}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items() if t not in added}
        self.encoding = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> np.ndarray:
        """The text's ids as unsigned 32-bit integers; the file's added tokens count as such wherever they stand."""
        return self.encoding.encode_to_numpy(text, allowed_special="all")


_TOKENIZERS: dict[str, PieceTokenizer] = {}


def piece_tokenizer(path: str) -> PieceTokenizer:
    """This Python worker's tokenizer; it holds the file's tables only."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, task, number [, ids]): a row for each
    piece; ``number`` counts the pieces of a length within a task, from 0."""
    def make():
        from pyspark import TaskContext
        keep_only()
        tokenizer, task = piece_tokenizer(path), TaskContext.get().partitionId()
        end = array("I", [end_id]).tobytes()
        seen = np.zeros(capacity + 1, dtype=np.int64)

        def f(batch):
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "number", "ids")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = tokenizer.encode(text.as_py() or "").astype("<u4", copy=False).tobytes() + end
                n = len(raw) // 4
                for start in range(0, n, capacity):
                    piece = raw[4 * start:4 * (start + capacity)]
                    length = len(piece) // 4
                    for k, x in (("doc_id", doc_id), ("start", start), ("length", length), ("ids_crc32", zlib.crc32(piece)),
                                 ("doc_tokens", n), ("task", task), ("number", int(seen[length]))):
                        out[k].append(x)
                    if with_ids:
                        out["ids"].append(np.frombuffer(piece, "<u4").astype("i4"))
                    seen[length] += 1
            return out

        return f

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task bigint, number bigint"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return map_columns(rows, schema + (", ids array<int>" if with_ids else ""), make)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first_rank, count, first_sequence, offset) from counts by length.

    Pieces of ``length`` with ranks first_rank .. first_rank + count - 1 stand at ``offset`` of
    the sequences first_sequence, first_sequence + 1, ...
    """
    open_packs: dict[int, list[list]] = {}  # room left -> [count, slots as (length, offset, rank)]
    done: list[list] = []
    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        rank, left = 0, histogram[length]
        changed: list[tuple[int, list]] = []
        while left:
            room = max(open_packs, default=0)  # the shortest pack has the most room
            if room < length:
                changed.append((capacity - length, [left, [(length, 0, rank)]]))
                break
            pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            taken = min(left, pattern[0])
            if taken < pattern[0]:  # the other packs of this kind stay as they are
                rest = [pattern[0] - taken, [(x, o, r + taken) for x, o, r in pattern[1]]]
                open_packs.setdefault(room, []).append(rest)
            changed.append((room - length, [taken, [*pattern[1], (length, capacity - room, rank)]]))
            rank, left = rank + taken, left - taken
            if room - length >= length:  # it may take another of this length
                open_packs.setdefault(room - length, []).append(changed.pop()[1])
        for room, pattern in changed:
            if room:
                open_packs.setdefault(room, []).append(pattern)
            else:
                done.append(pattern)
    slots, sequence = [], 0
    for count, parts in [*done, *(p for _, ps in sorted(open_packs.items()) for p in ps)]:
        slots += [(length, rank, count, sequence, offset) for length, offset, rank in parts]
        sequence += count
    return slots


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset [, ids]."""
    spark = docs.sparkSession
    pieces = written(tokenised_pieces(docs, path, capacity, end_id, with_ids), "pieces")
    by_task = written(pieces.groupBy("task", "length").agg((F.max("number") + 1).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(
        shortest_pack_first(histogram, capacity),
        "length bigint, first_rank bigint, count bigint, first_sequence bigint, at bigint")
    kinds = slots.groupBy("length").agg(F.array_sort(F.collect_list(
        F.struct("first_rank", "count", "first_sequence", "at"))).alias("slots"))
    before = F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = by_task.select("task", "length", before.alias("first"))
    ranked = pieces.join(starts, ["task", "length"]).withColumn("rank", F.col("first") + F.col("number"))
    slot = F.expr("element_at(slots, cast(size(filter(slots, s -> s.first_rank <= rank)) as int))")
    return (ranked.join(F.broadcast(kinds), "length").withColumn("slot", slot)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("slot.first_sequence") + F.col("rank") - F.col("slot.first_rank")).alias("sequence_id"),
                    F.col("slot.at").alias("offset"), *(["ids"] if with_ids else [])))
