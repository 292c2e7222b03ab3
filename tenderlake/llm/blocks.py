"""Documents in blocks, and questions about hashes between blocks and hash ranges.

Operators that compare parts of all texts (windows, words) do it by numbers.  ``packed``
deals documents to blocks by a hash of their id and compresses what a
task holds of each block, so that later steps shuffle a third of the text's size in a few rows.
Tasks over blocks send sorted arrays of 64-bit hashes, cut by hash range, to tasks over
ranges, and get back one answer for each hash they asked about, in the order they
asked.  Blocks and ranges are as many as the input needs, so that each fits in a task: a block holds
``BLOCK_CHARS`` characters on average, a range ``RANGE_HASHES`` hashes.
A hash that very many documents share comes once from each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import KEPT, map_columns

BLOCK_CHARS = 4_000_000
RANGE_HASHES = 2_000_000
PACKED = "block bigint, ids binary, sizes binary, texts binary, known boolean"


def total_chars(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0


def packed(docs: DataFrame, n_blocks: int, null_ids: bool = False) -> DataFrame:
    """Compressed runs of documents, null texts as empty.  Rows with a null doc_id are
    left out, or dealt by their texts and marked as not known."""
    def make():
        zip_ = zstandard.ZstdCompressor(level=1).compress

        def f(batch):
            out = {"block": [], "ids": [], "sizes": [], "texts": [], "known": []}
            ids, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "block"))
            known, texts = batch.column("known").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            order = np.lexsort((known, block))
            changes = (np.diff(block[order]) != 0) | (known[order][1:] != known[order][:-1])
            for part in np.split(order, np.flatnonzero(changes) + 1):
                raw = [texts[i].encode() for i in part.tolist()]
                out["block"].append(int(block[part[0]]))
                out["known"].append(bool(known[part[0]]))
                out["ids"].append(ids[part].astype("<i8").tobytes())
                out["sizes"].append(np.array([len(r) for r in raw], "<i8").tobytes())
                out["texts"].append(zip_(b"".join(raw)))
            return out

        return f

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = F.col("doc_id").isNotNull()
    rows = rows.select(F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("doc_id"), "text", known.alias("known"),
                       F.pmod(F.when(known, F.xxhash64("doc_id")).otherwise(F.xxhash64("text")), F.lit(n_blocks)).alias("block"))
    return map_columns(rows if null_ids else rows.filter("known"), PACKED, make)


def unpacked(table: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids in ascending order, texts (UTF-8) and whether the id is known, of a block."""
    ids, texts, known = [], [], []
    for row in zip(*(table.column(c).to_pylist() for c in ("ids", "sizes", "texts", "known"))):
        ids.append(np.frombuffer(row[0], "<i8"))
        known += [row[3]] * len(ids[-1])
        whole, at = zstandard.ZstdDecompressor().decompress(row[2]) if row[2] else b"", 0
        for n in np.frombuffer(row[1], "<i8").tolist():
            texts.append(whole[at:at + n])
            at += n
    every = np.concatenate(ids) if ids else np.zeros(0, "i8")
    # Equal ids are ordered by their texts, so that a block is the same each time it is put together.
    order = sorted(range(len(every)), key=lambda i: (every[i], known[i], texts[i]))
    return every[order], [texts[i] for i in order], np.array(known, bool)[order]


class WordHashes(dict):
    """64-bit hashes of words (bytes), kept while there are less than ``limit``."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One for each Python worker; what it holds follows from the words alone.
WORD_HASHES = WordHashes()
KEPT["word hashes"] = WORD_HASHES.clear

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` neighbours of ``h``, put together from runs of doubling widths."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        n = len(h) - width + 1
        out, done, run, size = None, 0, h, 1
        power = _ODD
        while True:
            if width & size:
                piece = run[done:done + n]
                out = piece.copy() if out is None else out * power + piece
                done += size
            if done == width:
                return mixed(out)
            run = run[:len(run) - size] * power + run[size:]
            power, size = power * power, size * 2


def zipped(a: np.ndarray) -> bytes:
    """A compressed array; sorted 64-bit arrays as differences."""
    if a.dtype == np.uint64 and len(a):
        a = np.diff(a, prepend=np.uint64(0))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unzipped(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    a = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)
    return np.cumsum(a, dtype=np.uint64) if kind == np.uint64 else a


def by_range(hashes: np.ndarray, n_ranges: int) -> Iterator[tuple[int, slice]]:
    """The non-empty slices of a sorted array of hashes, by range."""
    if not len(hashes):
        return
    which = hashes // np.uint64(max(1, (1 << 64) // n_ranges)) if n_ranges > 1 else np.zeros(len(hashes), np.uint64)
    cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(hashes)]
    for a, b in zip(cuts, cuts[1:]):
        yield int(which[a]), slice(a, b)


_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}


def arrow_table(rows: list[tuple], schema: str) -> pa.Table:
    """Rows as an Arrow table with the columns of a schema like "a bigint, b binary"."""
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(list(c), _KINDS[k]) for (n, k), c in zip(fields, columns)})
