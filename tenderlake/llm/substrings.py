"""Substring dedup with difference-cover anchors.

A window is ``WINDOW`` consecutive words.  The cover {0, 1, 3} holds, modulo its period 7, two
elements at every distance; so of two equal windows, wherever they start, some
shift below 7 brings both to positions in the cover.  It is therefore enough to hash the
runs of WINDOW - 6 words that start at cover positions (3 of 7): equal windows share such
an anchor at the same place.

1. Blocks of documents send the distinct hashes of their anchors to hash ranges, which answer
   whether an anchor occurs in two documents or more.
2. Around those anchors only, the match is extended to whole windows: their hashes go to ranges
   with the smallest document that has them in the block; the answer is
   the smallest document of all.
3. Windows whose smallest document is before their own cover their words; the others stay.

Windows are compared by 64-bit hashes mixed from the words' own; n windows of which no two are
equal are taken for equal with a chance of n*n / 2**65 (1e-3 for 2e8 windows).

Defined results: null text has no words, like an empty one; fewer than 13 words have no
window.  Rows repeated with one doc_id are not smaller than one another, so none covers another.
A null doc_id has no place in the order: such rows keep all words and cover none.  Empty table: empty
result.  Other columns are not read, but ``without_repeats`` returns them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import (BLOCK_CHARS, RANGE_HASHES, WORD_HASHES, arrow_table, by_range, packed, total_chars, unpacked, unzipped,
                     window_hashes, zipped)
from .shared import SPACE, written

WINDOW = 13
#: A difference cover modulo 7.  Fixed values.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1


class Words:
    """The words of a block's documents in one row of hashes."""

    def __init__(self, table: pa.Table):
        self.ids, self.texts, _ = unpacked(table)
        self.words = [t.split() for t in self.texts]  # bytes.split: the six ASCII white-space characters
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.counts)
        self.doc = np.repeat(np.arange(len(self.words)), self.counts)
        self.place = np.arange(len(self.doc)) - np.repeat(self.ends - self.counts, self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place  # words from here to the document's end
        self.hashes = WORD_HASHES.of([w for ws in self.words for w in ws])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and positions of the anchors at cover positions, in documents that have a window."""
        h = window_hashes(self.hashes, ANCHOR)
        at = np.flatnonzero(np.isin(self.place[:len(h)] % PERIOD, COVER) & (self.left[:len(h)] >= ANCHOR)
                            & (self.counts[self.doc[:len(h)]] >= WINDOW))
        return h[at], at

    def windows(self, shared_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and positions of the windows with one of these anchors inside."""
        h = window_hashes(self.hashes, WINDOW)
        near = np.zeros(len(self.doc) + 1, np.int32)
        starts = np.maximum(shared_at - (PERIOD - 1), 0)
        np.add.at(near, starts, 1)
        np.add.at(near, shared_at + 1, -1)
        at = np.flatnonzero((np.cumsum(near)[:len(h)] > 0) & (self.left[:len(h)] >= WINDOW))
        return h[at], at


def _ask_anchors(n_ranges: int):
    def f(table: pa.Table) -> pa.Table:
        block, words = table.column("block")[0].as_py(), Words(table)
        h, at = words.anchors()
        own = words.ids[words.doc[at]]
        hashes, first, group = np.unique(h, return_index=True, return_inverse=True)
        low, high = np.full(len(hashes), np.iinfo(np.int64).max), np.full(len(hashes), np.iinfo(np.int64).min)
        np.minimum.at(low, group, own)
        np.maximum.at(high, group, own)
        rows = [(r, block, zipped(hashes[s]), zipped((low[s] < high[s]).astype(np.uint8))) for r, s in by_range(hashes, n_ranges)]
        return arrow_table(rows, ASK)

    return f


def _answer_anchors(table: pa.Table) -> pa.Table:
    """For each block's hashes whether two documents have them."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("range", "block", "hashes", "values"))), key=lambda r: r[1])
    asked = [unzipped(r[2], np.uint64) for r in rows]
    several = [unzipped(r[3], np.uint8) for r in rows]
    hashes, group, times = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
    shared = times > 1
    shared[group[np.concatenate(several) > 0]] = True
    answers = np.split(shared[group].astype(np.uint8), np.cumsum([len(a) for a in asked])[:-1])
    return arrow_table([(r[0], r[1], b"", zipped(np.packbits(a))) for r, a in zip(rows, answers)], ASK)


def _shared_anchors(words: Words, answers: pa.Table, n_ranges: int) -> np.ndarray:
    h, at = words.anchors()
    hashes, group = np.unique(h, return_inverse=True)
    shared = np.zeros(len(hashes), bool)
    got = dict(zip(answers.column("range").to_pylist(), answers.column("values").to_pylist()))
    for r, s in by_range(hashes, n_ranges):
        shared[s] = np.unpackbits(unzipped(got[r], np.uint8))[:s.stop - s.start]
    return at[shared[group]]


def _ask_windows(n_ranges: int):
    def f(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return arrow_table([], ASK2)
        block, words = table.column("block")[0].as_py(), Words(table)
        shared_at = _shared_anchors(words, answers, n_ranges)
        h, at = words.windows(shared_at)
        hashes, first = np.unique(h, return_index=True)
        smallest = words.ids[words.doc[at[first]]]  # ids ascend, so the first occurrence has the smallest
        marks = np.packbits(np.bincount(shared_at, minlength=len(words.doc)).astype(bool)) if len(shared_at) else np.zeros(0, np.uint8)
        rows = [(r, block, zipped(hashes[s]), zipped(smallest[s]), b"") for r, s in by_range(hashes, n_ranges)]
        return arrow_table([*rows, (-1, block, b"", b"", zipped(marks))], ASK2)

    return f


def _answer_windows(table: pa.Table) -> pa.Table:
    """The smallest document of all for each hash of each block; 0 stands for the block's own answer."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("range", "block", "hashes", "values"))), key=lambda r: r[1])
    asked = [unzipped(r[2], np.uint64) for r in rows]
    own = np.concatenate([unzipped(r[3], np.int64) for r in rows])
    hashes, group = np.unique(np.concatenate(asked), return_inverse=True)
    least = np.full(len(hashes), np.iinfo(np.int64).max)
    np.minimum.at(least, group, own)
    # Answers are how far the smallest document is before the block's own.
    answers = np.split(own - least[group], np.cumsum([len(a) for a in asked])[:-1])
    return arrow_table([(r[0], r[1], b"", zipped(a), b"") for r, a in zip(rows, answers)], ASK2)


def _removed(words: Words, answers: pa.Table, n_ranges: int) -> np.ndarray:
    """Whether each word is covered by a window that an earlier document has."""
    got = {r: (v, m) for r, v, m in zip(*(answers.column(c).to_pylist() for c in ("range", "values", "marks")))}
    out = np.zeros(len(words.doc), bool)
    if -1 not in got:
        return out
    marks = np.unpackbits(unzipped(got[-1][1], np.uint8))[:len(out)]
    h, at = words.windows(np.flatnonzero(marks))
    hashes, first, group = np.unique(h, return_index=True, return_inverse=True)
    least = words.ids[words.doc[at[first]]] if len(at) else np.zeros(0, np.int64)
    for r, s in by_range(hashes, n_ranges):
        least[s] -= unzipped(got[r][0], np.int64)
    covers = at[least[group] < words.ids[words.doc[at]]]
    edge = np.zeros(len(out) + 1, np.int32)
    np.add.at(edge, covers, 1)
    np.add.at(edge, covers + WINDOW, -1)
    return np.cumsum(edge)[:-1] > 0


def _results(n_ranges: int, with_text: bool):
    def f(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        if table.num_rows:
            words = Words(table)
            removed = _removed(words, answers, n_ranges)
            for i, own in enumerate(words.words):
                if with_text and i and words.ids[i] == words.ids[i - 1] and words.texts[i] == words.texts[i - 1]:
                    continue
                cut = removed[words.ends[i] - len(own):words.ends[i]]
                n = int(cut.sum())
                kept = b" ".join([w for w, c in zip(own, cut.tolist()) if not c] if n else own)
                out.append((int(words.ids[i]), len(own), n, hashlib.sha256(kept).hexdigest(),
                            (kept if n else words.texts[i]).decode() if with_text else None,
                            hashlib.md5(words.texts[i]).hexdigest() if with_text else None))
        return arrow_table(out, RESULT)

    return f


ASK = "range bigint, block bigint, hashes binary, values binary"
ASK2 = ASK + ", marks binary"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string, text_md5 string"
def _known(docs: DataFrame, with_text: bool) -> DataFrame:
    """Results for rows with a doc_id; with texts, one for each (doc_id, text)."""
    chars = total_chars(docs)
    n_blocks, n_ranges = chars // BLOCK_CHARS + 1, chars // (6 * RANGE_HASHES) + 1
    blocks = written(packed(docs, n_blocks), "blocks")
    answers = (blocks.groupBy("block").applyInArrow(_ask_anchors(n_ranges), ASK)
               .groupBy("range").applyInArrow(_answer_anchors, ASK))
    asked = written(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_ask_windows(n_ranges), ASK2), "windows")
    answers = (asked.filter("range >= 0").groupBy("range").applyInArrow(_answer_windows, ASK2)
               .unionByName(asked.filter("range < 0")))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_results(n_ranges, with_text), RESULT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    words = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), f"[{SPACE}]+"), lambda w: w != "")
    no_id = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.size(words).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_removed"), F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))
    return _known(docs, False).select(*no_id.columns).unionByName(no_id)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, repeated words taken out of its texts (kept words joined by one space; texts
    that lose nothing stay as they are); documents that lose all their words go.  n_chars, if there, follows the text."""
    known = _known(docs, True).select(F.col("doc_id").alias("__id"), F.col("text_md5").alias("__md5"), F.col("kept_text").alias("__kept"),
                                      (F.col("n_removed") == F.col("n_words")).alias("__all"), F.col("n_words").alias("__n"))
    rows = docs.filter(F.col("doc_id").isNotNull()).withColumns(
        {"__own": F.md5(F.coalesce("text", F.lit(""))), "__null": F.col("text").isNull()}).drop("text")
    out = (rows.join(known, (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__md5")))
           .filter("not __all or __n = 0").withColumn("text", F.when(~F.col("__null"), F.col("__kept"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__null"), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))
