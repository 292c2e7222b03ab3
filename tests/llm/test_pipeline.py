"""The pipeline's stages against brute force, each on its own input."""

from __future__ import annotations

from collections import Counter

import pytest
from llm.conftest import ODD_ROWS
from llm.test_operators import brute_components, brute_repeats, by_id, check_packed, norm, sha

import corpus_pipeline as P

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, docs_of):
    """(input rows, output rows) of every stage, over sf0.01."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        after = P.shared.written(stage(spark, docs, SF), "test")
        if name != "packing":
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def test_quality_keeps_the_good(spark, steps):
    before, after = steps["quality classifier"]
    kept = {r["doc_id"] for r in after}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [(r["doc_id"] in kept) == bool(labels[r["doc_id"]]) for r in before if labels.get(r["doc_id"]) is not None]
    assert sum(right) >= 0.97 * len(right)
    assert set(after) <= set(before)


def test_exact_copies_go(steps):
    before, after = steps["exact dedup"]
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(norm(r["text"]), r)
    assert Counter(after) == Counter(first.values())


def test_near_copies_go(steps):
    before, after = steps["MinHash near-dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before]
    stay = {i for i, _, _, kept in brute_components(rows, 5) if kept}
    assert Counter(after) == Counter(r for r in before if r["doc_id"] in stay)


def test_repeated_passages_go(steps):
    before, after = steps["substring dedup"]
    want = {i: (n, cut, kept) for i, n, cut, kept in brute_repeats([(r["doc_id"], r["text"]) for r in before])}
    texts = {r["doc_id"]: r["text"] for r in before}
    assert {r["doc_id"] for r in after} == {i for i, (n, cut, _) in want.items() if cut < n or not n}
    for r in after:
        n, cut, kept = want[r["doc_id"]]
        assert r["text"] == texts[r["doc_id"]] if not cut else sha(r["text"]) == kept and r["n_chars"] == len(r["text"])


def test_all_is_packed(steps):
    before, after = steps["packing"]
    check_packed(after, [(r["doc_id"], r["text"]) for r in before], 1024)


def test_run_is_the_stages(spark, steps):
    rows = P.run(spark, SF).collect()
    got = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in steps["packing"][1])


def test_stages_stand_odd_and_empty_tables(spark, docs_of):
    for rows in (ODD_ROWS, []):
        docs = docs_of(rows)
        for name, stage in P.STAGES:
            after = stage(spark, docs, SF)
            if name != "packing":
                assert after.columns == docs.columns, name
            got = by_id(after)
            assert bool(got) == bool(rows), name
