"""MinHash near-dedup with an LSH forest.

A document's set holds its distinct runs of ``WIDTH`` words.  Equal sets form a class, and the smallest
doc_id stands for it from then on.

Forest: each of ``TREES`` trees sorts the classes by its own order of the signature's
values.  Classes that share the first ``MIN_DEPTH`` values in a tree share a region; a
region with more than ``SMALL`` classes goes deeper (``DEPTHS``) until its parts are small.
Candidates are the neighbour in sorted order (the longest common prefix) inside the part a class ends in, and the
smallest class of its region at every depth it went through; those are found by aggregations that
combine on the map side, so no region is gathered.  Candidates whose signatures agree
in less than ``LEAST_ESTIMATE`` are passed over (more than four standard deviations below
the threshold); all others are confirmed on the full sets.

The rest: regions that still hold several components after that are gone through whole.
By their signatures, every class outside the region's largest component is held against every class of
the region, in blocks of bounded size; where one may be linked to a class of another component, it
visits that class's cell.  A cell holds up to about ``BLOCK`` classes of one component (or of the small components around
it), each class in one cell; the full sets of its visitors are held against the full sets of its classes,
and what is linked is linked.  So no pairs are written out but links, and whatever the sizes of regions, a link
is lost only if its two classes share no region in any tree: (1 - 0.8**4)**20 = 3e-5 for a similarity of 0.8, less above.

Components are found by alternating stars over the written links.

Defined results: null texts and texts without words have an empty set and are linked with nothing;
one word is a set of its own.  A null doc_id has no component (null) and is kept.  Rows
with one doc_id and one text are in one class.  Empty table: empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import WORD_HASHES, mixed, window_hashes
from .components import components
from .shared import map_columns, written

WIDTH, THRESHOLD = 5, 80  # words in a shingle; percent
TREES, MIN_DEPTH, DEPTHS, SMALL = 20, 4, (4, 8, 12), 64
VALUES = TREES * MIN_DEPTH
LEAST_ESTIMATE = 0.6
BLOCK = 1024

_A = mixed(np.arange(1, VALUES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_B = mixed(np.arange(1001, VALUES + 1001, dtype=np.uint64)).astype(np.uint32)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words (A-Z lower-cased), or of all words if there are fewer."""
    words = text.encode().lower().split()  # bytes: ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(WORD_HASHES.of(words), min(width, len(words))))


def signature(s: np.ndarray) -> bytes:
    """The set's minima under VALUES hash functions, 16 bits of each."""
    low = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(s), 2048):
        part = (s[k:k + 2048] >> np.uint64(32)).astype(np.uint32)
        with np.errstate(over="ignore"):
            low = np.minimum(low, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1))
    return (mixed(low.astype(np.uint64)) >> np.uint64(48)).astype(">u2").tobytes()


def set_hash(s: np.ndarray) -> bytes:
    """128 bits of a set, whatever its order."""
    with np.errstate(over="ignore"):
        a, b = mixed(s ^ np.uint64(0x1234567)).sum(dtype=np.uint64), mixed(s + np.uint64(0x9876543)).sum(dtype=np.uint64)
    return np.array([a, b], "<u8").tobytes()


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, set_hash, signature); signature is null for an empty set."""
    def make():
        def f(batch):
            n, h, sig = [], [], []
            for t in batch.column("text").to_pylist():
                s = shingles(t or "", width)
                n.append(len(s))
                h.append(set_hash(s))
                sig.append(signature(s) if len(s) else None)
            return {"doc_id": batch.column("doc_id"), "n_shingles": n, "set_hash": h, "signature": sig}

        return f

    return map_columns(_texts(docs), "doc_id bigint, n_shingles bigint, set_hash binary, signature binary", make)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))


def forest_rows(classes: DataFrame) -> DataFrame:
    """(tree, key, node, p<depth>...): a row for each class and tree; key is its place in the tree's order."""
    rows = classes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    key = F.substring(F.concat("signature", "signature"), F.col("tree") * F.lit(2 * MIN_DEPTH) + F.lit(1), F.lit(2 * max(DEPTHS)))
    rows = rows.select("tree", "node", key.alias("key"))
    return rows.select("*", *[F.xxhash64("tree", F.lit(d), F.substring("key", 1, 2 * d)).alias(f"p{d}") for d in DEPTHS])


def _regions(rows: DataFrame, depth: int) -> DataFrame:
    """Rows in regions of two classes or more at a depth, with the region's size and smallest class."""
    regions = rows.groupBy(f"p{depth}").agg(F.count(F.lit(1)).alias(f"n{depth}"), F.min("node").alias(f"m{depth}"))
    return rows.join(regions.filter(F.col(f"n{depth}") > 1), f"p{depth}")


def candidates(in_regions: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: sorted neighbours and smallest classes, by adaptive depth."""
    out, rows, parts = None, in_regions, []
    for i, d in enumerate(DEPTHS):
        if i:
            rows = _regions(rows.select("tree", "key", "node", *[f"p{x}" for x in DEPTHS]), d)
        out = _union(out, rows.select("node", F.col(f"m{d}").alias("other")))
        parts.append(rows.filter(F.col(f"n{d}") <= SMALL).select("node", "key", F.col(f"p{d}").alias("part")))
        rows = rows.filter(F.col(f"n{d}") > SMALL)
    order = Window.partitionBy("part").orderBy("key", "node")
    for p in parts:  # at most SMALL rows in a part
        out = _union(out, p.select("node", F.lag("node").over(order).alias("other")).filter("other is not null"))
    return out.filter("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _union(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in LEAST_ESTIMATE of their values or more."""
    sig = classes.select("node", "signature")
    rows = (pairs.join(sig.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b"))

    def make():
        def f(batch):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, VALUES) for c in ("sa", "sb"))
            good = (x == y).sum(axis=1) >= LEAST_ESTIMATE * VALUES
            return {c: batch.column(c).to_numpy()[good] for c in ("a", "b")}

        return f

    return map_columns(rows.select("a", "b", "sa", "sb"), "a bigint, b bigint", make)


def full_sets(nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, s): the full sets of some classes, written."""
    # Known by its file's size, the planner broadcasts this only where it is small.
    wanted = written(nodes.select(F.col("node").alias("doc_id")).distinct(), "wanted")

    def make():
        return lambda batch: {"node": batch.column("doc_id"),
                              "s": [shingles(t or "", width).tobytes() for t in batch.column("text").to_pylist()]}

    return written(map_columns(_texts(docs).join(wanted, "doc_id"), "node bigint, s binary", make), "sets")


def _set_at(column, i: int) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), np.uint64)


def confirmed(pairs: DataFrame, docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs with 100 * intersection >= threshold * union on their full sets."""
    pairs = written(pairs, "likely")
    sets = full_sets(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))), docs, width)
    rows = (pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b"))

    def make():
        def f(batch):
            good, sa, sb = np.zeros(batch.num_rows, bool), batch.column("sa"), batch.column("sb")
            for i in range(batch.num_rows):
                x, y = _set_at(sa, i), _set_at(sb, i)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= threshold * (len(x) + len(y) - both)
            return {c: batch.column(c).to_numpy()[good] for c in ("a", "b")}

        return f

    return written(map_columns(rows.select("a", "b", "sa", "sb"), "a bigint, b bigint", make).distinct(), "confirmed")


def _mixed_rows(in_regions: DataFrame, known: DataFrame) -> DataFrame:
    """(node, region, c, most, all_blocks, rest_blocks): rows of regions with several components; most: the largest there."""
    labels = known.select("node", F.col("component").alias("c"))
    rows = in_regions.select("node", F.col(f"p{MIN_DEPTH}").alias("region")).join(labels, "node", "left") \
        .select("node", "region", F.coalesce("c", "node").alias("c"))
    shares = rows.groupBy("region", "c").agg(F.count(F.lit(1)).alias("k"))
    regions = (shares.groupBy("region").agg(F.max_by("c", F.struct("k", "c")).alias("most"), F.sum("k").alias("n"),
                                            F.max("k").alias("k"), F.count(F.lit(1)).alias("kinds"))
               .filter("kinds > 1")
               .select("region", "most", F.ceil(F.col("n") / BLOCK).alias("all_blocks"),
                       F.ceil((F.col("n") - F.col("k")) / BLOCK).alias("rest_blocks")))
    return rows.join(regions, "region")


def _cells(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(node, c, cell): the one cell of each class.  Classes of a component with SMALL classes or more
    share its cells; others go to the cells of small components around a largest one."""
    sizes = known.groupBy(F.col("component").alias("c")).agg(F.count(F.lit(1)).alias("size"))
    homes = rows.groupBy("node", "c").agg(F.min("most").alias("near")).join(sizes, "c", "left")
    large = F.coalesce(F.col("size") >= SMALL, F.lit(False))
    homes = homes.select("node", "c", F.xxhash64(large, F.when(large, F.col("c")).otherwise(F.col("near"))).alias("home"))
    blocks = homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    return homes.join(blocks, "home").select("node", "c", F.xxhash64("home", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("cell"))


class _Groups:
    """Runs of rows with one key, from sorted batches; a run may go over several batches."""

    def __init__(self, key: str, columns: tuple[str, ...]):
        self.key, self.columns, self.held = key, columns, {}

    def add(self, now: dict[str, np.ndarray]) -> list[dict[str, np.ndarray]]:
        for k, v in now.items():
            self.held[k] = np.concatenate([self.held[k], v]) if k in self.held else v
        return self._cut(False)

    def rest(self) -> list[dict[str, np.ndarray]]:
        return self._cut(True)

    def _cut(self, last: bool) -> list[dict[str, np.ndarray]]:
        keys = self.held.get(self.key)
        if keys is None or not len(keys):
            return []
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        spans = list(zip(cuts, cuts[1:]))
        done, keep = (spans, len(keys)) if last else (spans[:-1], spans[-1][0])
        out = [{k: self.held[k][a:b] for k in self.columns} for a, b in done]
        self.held = {k: v[keep:] for k, v in self.held.items()}
        return out


def _visits(rows: DataFrame, cells: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct (node, cell): classes that may be linked, by their signatures, to a class of another component in that cell."""
    rows = rows.join(cells.select("node", F.col("cell").alias("own")), "node").join(classes.select("node", "signature"), "node")
    every = F.explode(F.transform(F.sequence(F.lit(0), F.col("rest_blocks") - 1), lambda r: F.struct(
        F.pmod(F.xxhash64("node"), F.col("all_blocks")).alias("x"), r.alias("y"))))
    rest = F.explode(F.transform(F.sequence(F.lit(0), F.col("all_blocks") - 1), lambda x: F.struct(
        x.alias("x"), F.pmod(F.xxhash64("node"), F.col("rest_blocks")).alias("y"))))
    columns = ["region", "node", "c", "own", "signature"]
    sides = (rows.select(*columns, F.lit(False).alias("rest"), every.alias("at"))
             .unionByName(rows.filter("c <> most").select(*columns, F.lit(True).alias("rest"), rest.alias("at"))))
    sides = sides.select(F.xxhash64("region", "at.x", "at.y").alias("part"), "node", "c", "own", "signature", "rest")

    def visits_of(g: dict[str, np.ndarray]) -> set[tuple[int, int]]:
        out = set()
        for i in np.flatnonzero(g["rest"]).tolist():
            may = ((g["sig"] == g["sig"][i]).sum(axis=1) >= LEAST_ESTIMATE * VALUES) & ~g["rest"] & (g["c"] != g["c"][i])
            out.update((int(g["node"][i]), int(cell)) for cell in np.unique(g["own"][may]))
        return out

    def run(batches):
        groups = _Groups("part", ("node", "c", "own", "rest", "sig"))

        def table(found):
            pairs = sorted(set().union(*map(visits_of, found)))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["node", "cell"])

        for batch in batches:
            if batch.num_rows:
                now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("part", "node", "c", "own", "rest")}
                now["sig"] = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(-1, VALUES)
                yield table(groups.add(now))
        yield table(groups.rest())

    return sides.repartition("part").sortWithinPartitions("part").mapInArrow(run, "node bigint, cell bigint").distinct()


class _Cell:
    """Full sets of a cell's classes, by their elements."""

    def __init__(self):
        self.nodes, self.c, self.sets = [], [], []
        self.index = None

    def add(self, node: int, c: int, s: np.ndarray) -> None:
        self.nodes.append(node)
        self.c.append(c)
        self.sets.append(s)

    def links(self, node: int, c: int, s: np.ndarray, threshold: int) -> list[tuple[int, int]]:
        """Links of a visitor, one to each other component in the cell."""
        if not self.sets:
            return []
        if self.index is None:
            sizes = np.array([len(x) for x in self.sets])
            values = np.concatenate(self.sets)
            order = np.argsort(values, kind="stable")
            self.index = values[order], np.repeat(np.arange(len(sizes)), sizes)[order], sizes, np.array(self.c)
            self.sets = [s[:0] for s in self.sets]
        values, owner, sizes, comps = self.index
        low, high = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
        length = high - low
        at = np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())
        both = np.bincount(owner[at], minlength=len(sizes))
        good = np.flatnonzero((100 * both >= threshold * (sizes + len(s) - both)) & (comps != c))
        _, first = np.unique(comps[good], return_index=True)
        return [(min(node, self.nodes[i]), max(node, self.nodes[i])) for i in good[first].tolist()]


def leftover_links(in_regions: DataFrame, classes: DataFrame, known: DataFrame, docs: DataFrame,
                   width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): links between classes that share a region and are in different components, one at least
    for each class and other component that have any."""
    rows = written(_mixed_rows(in_regions, known), "mixed")
    cells = written(_cells(rows, known), "cells")
    visits = written(_visits(rows, cells, classes), "visits")
    hosts = cells.join(visits.select("cell").distinct(), "cell", "left_semi")
    sets = full_sets(visits.select("node").unionByName(hosts.select("node")), docs, width)
    sides = (hosts.select("cell", F.lit(0).alias("visitor"), "node", "c")
             .unionByName(visits.join(cells.select("node", "c"), "node").select("cell", F.lit(1).alias("visitor"), "node", "c"))
             .join(sets, "node").select("cell", "visitor", "node", "c", "s"))

    def run(batches):
        here, cell = None, None
        for batch in batches:
            links, s = [], batch.column("s")
            for i, (at, visitor, node, c) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("cell", "visitor", "node", "c")))):
                if at != here:
                    here, cell = at, _Cell()
                own = _set_at(s, i)
                if visitor:
                    links += cell.links(node, c, own, threshold)
                else:
                    cell.add(node, c, own.copy())
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return written(sides.repartition("cell").sortWithinPartitions("cell", "visitor").mapInArrow(run, "a bigint, b bigint").distinct(), "leftover")


def near_components(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    rows = written(sketches(docs, width), "sketches")
    classes = written(rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_hash", "n_shingles")
                      .agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature")), "classes")
    in_regions = written(_regions(forest_rows(classes), MIN_DEPTH), "regions")
    links = confirmed(likely(candidates(in_regions), classes), docs, width, threshold)
    known = written(components(links), "components")
    more = leftover_links(in_regions, classes, known, docs, width, threshold)
    known = written(components(links.unionByName(more)), "components") if more.limit(1).count() else known
    rep = classes.select("set_hash", "n_shingles", "node")
    out = (rows.select("doc_id", "n_shingles", "set_hash").join(rep, ["set_hash", "n_shingles"], "left")
           .join(known, "node", "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id")
    return out.select("doc_id", "n_shingles", component).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one_each(docs: DataFrame, width: int = WIDTH, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component, with all its columns."""
    gone = written(near_components(docs, width, threshold).filter("not kept").select(F.col("doc_id").alias("__id")).distinct(), "near")
    return docs.join(gone, F.col("doc_id") == F.col("__id"), "left_anti")
