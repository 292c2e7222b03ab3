"""Ranked lexical search: the best documents of every item by a dual-tree search.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z
are lower-cased.  The score of a document for an item is the sum, over the item's distinct terms, of
``w * ((1000000000*tf) div (1000*tf + 20*m))`` with integer weights (see :func:`weights`): a
dot product of the item's 0/1 vector and the document's vector of non-negative coordinates.

Two hierarchies are searched together.  Documents are cut into blocks, and each block into a
binary tree: a node is split by the term that about half of its documents have.  Items of a
batch form such a tree too.  A node holds the largest value of each coordinate below it, so the
dot product of an item node's and a document node's maxima bounds the score of every pair below
them.  A pair of nodes whose bound is less than the weakest kth score among the node's items is left
out with all that is below it, which loses nothing; other pairs are split until single items meet
leaves, where the scores are computed.

1. One pass over the documents writes the index: a row for each block with its tree, the
   documents' lengths and the frequencies of those terms that items have.  Every document counts.
2. The document frequencies, summed over blocks, give the weights (bounded by the batch's terms).
3. Each item meets the most promising leaf of every block; the kth best of these scores is a
   score that the item's kth best document has at least.
4. The dual-tree search over all blocks starts from these scores.  A task returns at most k
   documents for an item; two rounds of Spark's ranking (salted, then by item) merge them.

Items are taken in batches of about ``BATCH_TERMS`` terms, each a pass over the documents: a batch is
what goes to the driver and is broadcast, so that is bounded however many items there are (one item
alone with more terms is a batch by itself).  No limit drops a candidate.

Defined results: null text has no terms.  Items without terms have no rows, and documents
without any of an item's terms none for it.  Each row of either table stands for itself: a repeated
doc_id is ranked as often as it occurs, a repeated item_id has its documents once for each row.  Of
equal scores the smaller doc_id comes first, a null one last.  An empty table on either side gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .shared import map_columns, ship, written

#: Documents in a leaf at most, and documents and postings in a block.
LEAF = 64
BLOCK_DOCS = 2048
BLOCK_POSTINGS = 400_000
#: Terms of a batch of items, repeats included.
BATCH_TERMS = 65_536
#: Scores that a block gives for an item's first threshold; no result depends on them.
SEEDS = 8
#: Parts in which an item's candidates are ranked before they meet.
SALTS = 32

#: Every ASCII character but letters and digits becomes a space, A-Z become a-z; other bytes stay.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

INDEX = (
    "doc_ids array<bigint>, lengths array<bigint>, starts array<int>, terms array<int>, tfs array<bigint>, "
    "low array<int>, high array<int>, right array<int>, n_docs bigint, n_words bigint, df_terms array<int>, df_counts array<bigint>")
FOUND = "item bigint, item_id bigint, doc_id bigint, score bigint"


def terms_of(raw: bytes | None) -> list[bytes]:
    """All terms of a UTF-8 text, in order."""
    return raw.translate(TERM_BYTES).split() if raw else []


# -- trees -----------------------------------------------------------------------------------------------------------


def grow(starts: np.ndarray, terms: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, low, high, right) of a binary tree over the rows of a sparse 0/1 matrix: node i, in
    preorder, holds ``order[low[i]:high[i]]``; its children are i + 1 and ``right[i]`` (0: a leaf).  A node of
    more than ``leaf`` rows is split by the term whose row count is nearest to half of them."""
    n = len(starts) - 1
    order, low, high, right = [], [], [], []
    rows_of = np.repeat(np.arange(n), np.diff(starts))
    todo = [(np.arange(n), rows_of, terms, -1)]
    mark = np.zeros(n, bool)
    while todo:
        rows, at, t, parent = todo.pop()
        if parent >= 0:
            right[parent] = len(low)
        low.append(len(order))
        high.append(len(order) + len(rows))
        right.append(0)
        if len(rows) <= leaf:
            order.extend(rows.tolist())
            continue
        have = np.empty(0, np.int64)
        if len(t):
            count = np.bincount(t)
            best = int(np.argmin(np.abs(2 * count - len(rows))))
            if 0 < count[best] < len(rows):
                have = at[t == best]
        if not len(have):
            have = rows[:len(rows) // 2]
        mark[have] = True
        inside = mark[rows]
        posting = mark[at]
        mark[have] = False
        todo.append((rows[~inside], at[~posting], t[~posting], len(low) - 1))
        todo.append((rows[inside], at[posting], t[posting], -1))
    return np.array(order, np.int64), np.array(low, np.int64), np.array(high, np.int64), np.array(right, np.int64)


def rows_at(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the chosen rows' entries, starts among them) in a table of rows with ``starts``."""
    sizes = starts[chosen + 1] - starts[chosen]
    ends = np.cumsum(sizes)
    begin = ends - sizes
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[chosen] - begin, sizes), begin


class Items:
    """A batch of items: its terms by number, and the tree over its items."""

    def __init__(self, rows: list[tuple[int, int | None, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        lists = [np.array(sorted({number(t, len(self.vocabulary)) for t in terms}), np.int64) for _, _, terms in rows]
        starts = np.cumsum([0] + [len(x) for x in lists])
        order, self.low, self.high, self.right = grow(starts, np.concatenate(lists), 1)
        self.keys = [rows[i][:2] for i in order]
        # The union of the terms below each node: the maxima of 0/1 coordinates.
        of = [np.unique(np.concatenate([lists[i] for i in order[a:b]])) for a, b in zip(self.low, self.high)]
        self.starts = np.cumsum([0] + [len(x) for x in of])
        self.terms = np.concatenate(of)

    def children(self, nodes: np.ndarray) -> np.ndarray:
        """The nodes with inner ones replaced by their two children."""
        inner = nodes[self.right[nodes] > 0]
        return np.concatenate([nodes[self.right[nodes] == 0], inner + 1, self.right[inner]])


# -- index -----------------------------------------------------------------------------------------------------------


class _Block:
    """Documents of a block as they come."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.tfs, self.sizes = [], [], [], [], []
        self.docs = self.words = 0

    def row(self) -> dict:
        starts = np.cumsum([0] + self.sizes)
        terms, tfs = np.array(self.terms, np.int64), np.array(self.tfs, np.int64)
        order, low, high, right = grow(starts, terms, LEAF)
        at, begin = rows_at(starts, order)
        df_terms, df_counts = np.unique(terms, return_counts=True)
        return {"doc_ids": [self.ids[i] for i in order], "lengths": [self.lengths[i] for i in order],
                "starts": np.append(begin, len(at)), "terms": terms[at], "tfs": tfs[at], "low": low, "high": high, "right": right,
                "n_docs": self.docs, "n_words": self.words, "df_terms": df_terms, "df_counts": df_counts}


def index(docs: DataFrame, items: Items) -> DataFrame:
    """The written index of the documents' blocks for a batch of items."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(items.vocabulary)
    arrow = to_arrow_schema(StructType.fromDDL(INDEX))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        block = _Block()

        def out() -> pa.RecordBatch:
            row = block.row()
            return pa.RecordBatch.from_arrays([pa.array([row[c.name]], c.type) for c in arrow], schema=arrow)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for doc_id, raw in zip(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist()):
                    words = terms_of(raw)
                    if not words:
                        continue
                    block.docs += 1
                    block.words += len(words)
                    found = [(number(t), k) for t, k in Counter(words).items() if t in shared.value]
                    if not found:
                        continue
                    block.ids.append(doc_id)
                    block.lengths.append(len(words))
                    block.sizes.append(len(found))
                    block.terms.extend([t for t, _ in found])
                    block.tfs.extend([k for _, k in found])
                    if len(block.ids) >= BLOCK_DOCS or len(block.terms) >= BLOCK_POSTINGS:
                        yield out()
                        block = _Block()
        if block.docs:
            yield out()

    return written(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, INDEX), "search-index")


def weights(indexed: DataFrame, n_terms: int) -> tuple[np.ndarray, int, int]:
    """(w of each term, N documents with terms, L terms of all documents)."""
    total = indexed.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n, words = total[0] or 0, total[1] or 0
    counted = (indexed.select(F.explode(F.arrays_zip("df_terms", "df_counts")).alias("x"))
               .groupBy(F.col("x.df_terms").alias("term")).agg(F.sum("x.df_counts").alias("df")).collect())
    w = np.zeros(n_terms, np.int64)
    for term, df in counted:
        w[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    return w, n, words


# -- search ----------------------------------------------------------------------------------------------------------


class Block:
    """A block of the index with its documents' coordinates and the maxima of its nodes."""

    def __init__(self, row: dict, w: np.ndarray, n: int, words: int):
        array = {k: np.asarray(v, np.int64) for k, v in row.items() if k not in ("doc_ids", "n_docs", "n_words")}
        self.ids = row["doc_ids"]
        self.starts, self.terms, self.low, self.high, self.right = (array[k] for k in ("starts", "terms", "low", "high", "right"))
        sizes = np.diff(self.starts)
        m = 100 - 50 + (50 * array["lengths"] * n) // words
        tf = array["tfs"]
        self.values = w[self.terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)))
        self.maxima = np.zeros((len(self.low), len(w)), np.int64)
        leaves = np.flatnonzero(self.right == 0)
        leaf_of = np.repeat(leaves, self.high[leaves] - self.low[leaves])  # leaves are in the order of their documents
        np.maximum.at(self.maxima.reshape(-1), np.repeat(leaf_of, sizes) * len(w) + self.terms, self.values)
        for i in np.flatnonzero(self.right)[::-1]:
            np.maximum(self.maxima[i + 1], self.maxima[self.right[i]], out=self.maxima[i])

    def bounds(self, items: Items, node: int, chosen: np.ndarray) -> np.ndarray:
        """For each chosen item node, what no pair below it and ``node`` can exceed."""
        at, begin = rows_at(items.starts, chosen)
        return np.add.reduceat(self.maxima[node][items.terms[at]], begin)

    def scores(self, items: Items, leaf: int, chosen: np.ndarray) -> np.ndarray:
        """Scores of a leaf's documents (rows) for single-item nodes (columns)."""
        at, begin = rows_at(items.starts, chosen)
        needed, column = np.unique(items.terms[at], return_inverse=True)
        place = np.full(self.maxima.shape[1], -1)
        place[needed] = np.arange(len(needed))
        a, b = self.low[leaf], self.high[leaf]
        part = slice(self.starts[a], self.starts[b])
        where = place[self.terms[part]]
        row = np.repeat(np.arange(b - a), np.diff(self.starts[a:b + 1]))
        dense = np.zeros((b - a, len(needed)), np.int64)
        dense[row[where >= 0], where[where >= 0]] = self.values[part][where >= 0]
        return np.add.reduceat(dense[:, column], begin, axis=1)


def _key(score: int, doc_id: int | None) -> tuple:
    return -score, doc_id is None, doc_id or 0


class Search:
    """Best documents of a batch's items over the blocks that a task meets."""

    def __init__(self, items: Items, k: int, least: dict[int, tuple[int, int | None]]):
        """least: by position in the batch, the score and doc_id of a document that as many as k are not worse than."""
        self.items, self.k = items, k
        self.limit = [_key(*least[i]) if i in least else (-1, False, -2**63) for i in range(len(items.keys))]
        self.best: list[list[tuple]] = [[] for _ in items.keys]
        self.weakest = np.array([-x[0] for x in self.limit], np.int64)
        self.scored = self.pruned = 0

    def node_weakest(self) -> np.ndarray:
        """The least threshold of the items below each item node."""
        items = self.items
        got = np.empty(len(items.low), np.int64)
        for i in range(len(got) - 1, -1, -1):
            got[i] = min(got[i + 1], got[items.right[i]]) if items.right[i] else self.weakest[items.low[i]]
        return got

    def block(self, block: Block) -> None:
        least = self.node_weakest()
        items = self.items
        todo = [(0, np.array([0]))]
        while todo:
            node, chosen = todo.pop()
            leaf = block.right[node] == 0
            while len(chosen):
                near = block.bounds(items, node, chosen) >= np.maximum(least[chosen], 1)
                self.pruned += int((~near).sum())
                chosen = chosen[near]
                if not leaf or not items.right[chosen].any():
                    break
                chosen = items.children(chosen)
            if not len(chosen):
                continue
            if not leaf:
                below = items.children(chosen)
                todo += [(int(block.right[node]), below), (node + 1, below)]
            elif self.leaf(block, node, chosen):
                least = self.node_weakest()

    def leaf(self, block: Block, leaf: int, chosen: np.ndarray) -> bool:
        """Scores a leaf; whether any threshold rose."""
        got = block.scores(self.items, leaf, chosen)
        self.scored += got.size
        item = self.items.low[chosen]
        rose = False
        good = got >= np.maximum(self.weakest[item], 1)
        for c in np.flatnonzero(good.any(axis=0)):
            i = int(item[c])
            new = [_key(int(got[r, c]), block.ids[block.low[leaf] + r]) for r in np.flatnonzero(good[:, c])]
            best = sorted(self.best[i] + [x for x in new if x <= self.limit[i]])[:self.k]
            if len(best) == self.k and best[-1] < self.limit[i]:
                self.limit[i], self.weakest[i], rose = best[-1], -best[-1][0], True
            self.best[i] = best
        return rose

    def seeds(self, block: Block) -> None:
        """The best scores of each item in the leaf that promises most for it."""
        leaves = np.flatnonzero(block.right == 0)
        single = np.flatnonzero(self.items.right == 0)
        bounds = np.stack([block.bounds(self.items, leaf, single) for leaf in leaves])
        choice = np.where(bounds.max(axis=0) > 0, bounds.argmax(axis=0), -1)
        for k, leaf in enumerate(leaves):
            mine = single[choice == k]
            if len(mine):
                got = block.scores(self.items, leaf, mine)
                for c, node in enumerate(mine):
                    new = sorted(_key(int(s), block.ids[block.low[leaf] + r]) for r, s in enumerate(got[:, c]) if s > 0)[:SEEDS]
                    self.best[int(self.items.low[node])] += new

    def rows(self) -> Iterator[tuple]:
        for (number, item_id), best in zip(self.items.keys, self.best):
            for score, none, doc_id in best:
                yield number, item_id, None if none else doc_id, -score


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their ranks: ranked in salted parts first, so that no task gets all of an item's."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    part = part.withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def _over_blocks(indexed: DataFrame, task) -> DataFrame:
    """(item, item_id, doc_id, score) rows that ``task`` yields for the blocks of each partition."""
    arrow = to_arrow_schema(StructType.fromDDL(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    one = batch.slice(i, 1)
                    if len(one.column("doc_ids")[0]):
                        yield {c: (one.column(c).flatten() if c != "doc_ids" else one.column(c)[0].as_py())
                               for c in ("doc_ids", "lengths", "starts", "terms", "tfs", "low", "high", "right")}
        rows: list[tuple] = []
        for row in task(blocks()):
            rows.append(row)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=arrow)

    return indexed.drop("n_docs", "n_words", "df_terms", "df_counts").mapInArrow(run, FOUND)


def search_batch(docs: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, item_id, rank, doc_id, score) of one batch's items, written."""
    spark = docs.sparkSession
    indexed = index(docs, items)
    w, n, words = weights(indexed, len(items.vocabulary))
    shared = spark.sparkContext.broadcast((items, w, n, words))
    position = {number: i for i, (number, _) in enumerate(items.keys)}

    def seeds(blocks: Iterator[dict]) -> Iterator[tuple]:
        batch, *own = shared.value
        for row in blocks:
            search = Search(batch, k, {})
            search.seeds(Block(row, *own))
            yield from search.rows()

    first = _best_rows(_over_blocks(indexed, seeds), k).filter(F.col("rank") == k).select("item", "score", "doc_id").collect()
    least = {position[r["item"]]: (r["score"], r["doc_id"]) for r in first}

    def dual(blocks: Iterator[dict]) -> Iterator[tuple]:
        batch, *own = shared.value
        search = Search(batch, k, least)
        for row in blocks:
            search.block(Block(row, *own))
        yield from search.rows()

    return written(_best_rows(_over_blocks(indexed, dual), k).select("item_id", "rank", "doc_id", "score"), "search-found")


# -- batches of items ------------------------------------------------------------------------------------------------


def _numbered(items: DataFrame, batch_terms: int) -> DataFrame:
    """(item, item_id, terms, batch) rows, written: each item with terms gets a number, and its batch by the running
    sum of terms, from the sums of the parts before its own."""
    def make():
        def f(batch: pa.RecordBatch) -> dict:
            terms = [sorted(set(terms_of(raw))) for raw in batch.column(1).cast(pa.large_binary()).to_pylist()]
            return {"item_id": batch.column(0), "terms": terms, "size": [len(t) for t in terms]}
        return f

    own = map_columns(items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")),
                      "item_id bigint, terms array<binary>, size bigint", make)
    rows = written(own.filter("size > 0").withColumn("item", F.monotonically_increasing_id()), "search-items")
    rows = rows.withColumn("part", F.shiftright("item", 33))
    before = (rows.groupBy("part").agg(F.sum("size").alias("total"))
              .select("part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("before")))
    within = F.sum("size").over(W.partitionBy("part").orderBy("item")) - F.col("size")
    at = rows.select("item", "part", within.alias("within")).join(before, "part")
    batch = at.select("item", F.floor((F.col("before") + F.col("within")) / batch_terms).cast("bigint").alias("batch"))
    return written(rows.select("item", "item_id", "terms").join(batch, "item"), "search-batches")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 50, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """The k highest-scoring rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text):
    item_id, rank, doc_id, score."""
    spark: SparkSession = docs.sparkSession
    numbered = _numbered(items, batch_terms)
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for number in sorted(r["batch"] for r in numbered.select("batch").distinct().collect()):
        rows = numbered.filter(F.col("batch") == number).orderBy("item").select("item", "item_id", "terms").collect()
        out = out.unionByName(search_batch(docs, Items([(r[0], r[1], [bytes(t) for t in r[2]]) for r in rows]), k))
    return out
