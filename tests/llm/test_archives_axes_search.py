"""WARC archives, whitening and ranked search against brute force, on odd rows and empty tables."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import re
import struct
from collections import Counter

import numpy as np
import pytest
import zstandard
from llm.conftest import LONG, ODD_ROWS, PASSAGE, words
from pyspark.sql import functions as F

from tenderlake.llm import ranked_search, warc, whitening

# -- 11 --------------------------------------------------------------------------------------------------------------

PAGE = "page_id bigint, url string, html string, keep_id string, archive string, size string, copies int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", "a", "s", 1) for i, u, h in rows], PAGE).repartition(3)


ODD_PAGES = [
    (1, "http://a.example/1", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"), (3, "http://b.example/ x\r\nWARC-Type: forged", "<p>one</p>"),
    (4, None, None), (5, "", ""), (-6, "http://c.example/é ", "ünï\r\n\r\nWARC/1.1\r\n\x00"), (7, "u", LONG), (8, "u", LONG),
    (9, "u", "twice"), (9, "v", "twice"), (10, "w", "twice"), (None, "n", "<p>one</p>"), (None, "n", "only null ids"), (None, "m", "only null ids"),
    (2**62, "x", "<p>two</p>"), *[(100 + i, f"http://d.example/{i}", f"<html><body><h1>Page</h1><p>{i} {PASSAGE}</p></body></html>") for i in range(40)]]


def page_rows(rows, least=0):
    keep = {}
    for i, _, h in rows:
        if i is not None:
            keep[h or ""] = min(keep.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = keep.get(h or "") if len(raw) >= least else None
        to = None if to == i else to
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 7])
def test_archived_pages_read_back(spark, least):
    got = warc.archived_digests(pages_of(spark, ODD_PAGES), least=least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == page_rows(ODD_PAGES, least)


def test_large_groups_are_joined_by_broadcast_to_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "HEAVY", 0.04)
    rows = [(i, "u", "same") for i in range(60)] + ODD_PAGES
    got = warc.archived_digests(pages_of(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == page_rows(rows)


def test_no_pages_make_no_archive(spark):
    assert warc.write_archives(pages_of(spark, [])).count() == 0
    assert warc.archived_digests(pages_of(spark, [])).count() == 0


def test_archives_roll_hold_their_dictionary_and_give_single_records(spark, tmp_path):
    manifest = warc.write_archives(pages_of(spark, ODD_PAGES).coalesce(1), folder=str(tmp_path), archive_bytes=3_000)
    listed = manifest.collect()
    assert len(listed) > 2 and sum(r["records"] - 1 for r in listed) == len(ODD_PAGES)  # one warcinfo in each
    records = warc.read_archives(manifest).collect()
    for r in records:
        fields, block = warc.parsed(warc.read_at(r["archive"], r["offset"], r["length"]))
        assert fields["warc-record-id"] == r["record_id"] and fields["warc-type"] == r["record_type"]
        assert "\n" not in (r["uri"] or "") and "warc-type" in fields
        if r["record_type"] == "response":
            assert block.endswith(bytes(r["payload"])) and len(r["payload"]) == r["payload_bytes"]
    by_id = {r["record_id"]: r for r in records}
    for r in records:
        if r["refers_to"] is not None:
            assert by_id[r["refers_to_record"]]["page_id"] == r["refers_to"] and by_id[r["refers_to_record"]]["record_type"] == "response"
    with open(listed[0]["archive"].removeprefix("file://"), "rb") as f:
        raw = f.read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and size > 0
    # zstd itself skips the frame; the first record needs the embedded dictionary.
    own = zstandard.ZstdCompressionDict(raw[8:8 + size])
    assert zstandard.ZstdDecompressor(dict_data=own).decompressobj().decompress(raw[8 + size:]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_dictionary_pays_for_small_records():
    texts = [warc.page_record(i, f"http://d.example/{i}", f"<html><h1>{' '.join(words(12, i))}</h1></html>".encode(), None, "2020-01-01T00:00:00Z")
             for i in range(400)]
    with_it, without = (warc.ArchiveWriter(io.BytesIO(), d) for d in (warc.trained(texts), b""))
    for t in texts:
        with_it.add(t)
        without.add(t)
    assert with_it.bytes - len(warc.trained(texts)) < 0.7 * without.bytes
    assert warc.trained([]) == b""


def test_broken_archives_are_errors():
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, b"")
    record = warc.page_record(1, "u", b"payload" * 100, None, "2020-01-01T00:00:00Z")
    writer.add(record)
    writer.add(record)
    raw = out.getvalue()
    assert [r for _, _, r in warc.read_frames(io.BytesIO(raw))] == [record, record]
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(raw[:-5])))
    with pytest.raises(ValueError):
        list(warc.read_frames(io.BytesIO(raw[8:])))
    with pytest.raises(ValueError):
        warc.parsed(record.replace(b"payloadpayload", b"paylOadpayload", 1))
    with pytest.raises(ValueError):
        warc.parsed(record[:-6])


# -- 12 --------------------------------------------------------------------------------------------------------------

VEC = "vec_id bigint, embedding array<float>, n string, x string, component string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "n", "x", "c") for i, v in rows], VEC).repartition(3)


def brute_axes(rows):
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows])
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    c = u - sums / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    return x, n, sums, e[::-1], q[:, ::-1], np.trace(v)


def test_whitening_against_dense_eigenvectors(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal((300, 20)) @ np.diag(np.linspace(3, 0.5, 20))
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    good += [(1000 + i, good[0][1]) for i in range(200)] + [(None, good[1][1]), (5, good[2][1])]  # repeats count once
    bad = [(2000, None), (2001, [None] + good[0][1][1:]), (2002, [float("nan")] + good[0][1][1:]), (2003, [float("inf")] + good[0][1][1:]),
           (2004, [1.0, 2.0]), (2005, [])]
    got = whitening.whitened(vectors_of(spark, good + bad)).collect()
    x, n, sums, e, q, trace = brute_axes(good)
    assert len(got) == 4 * len(good) and {r["n"] for r in got} == {n} == {300}
    signs = {}
    expected = {}
    for (i, _), row in zip(good, x):
        z = (row - sums / n) @ q[:, :4] / np.sqrt(e[:4])
        expected.setdefault(i, []).append((int(((n * row - sums) ** 2).sum()), z))
    for r_ in got:
        k = r_["component"]
        options = expected[r_["vec_id"]]
        assert r_["deviation"] in [d for d, _ in options]
        z = next(z for d, z in options if d == r_["deviation"])[k - 1]
        if abs(z) > 1e-3:
            signs.setdefault(k, set()).add(np.sign(z) == np.sign(r_["whitened"]))
        assert abs(abs(z) - abs(r_["whitened"])) < 1e-9
        assert abs(r_["explained"] - e[k - 1] / trace) < 1e-12 and r_["identity_error"] < 1e-9 and r_["residual"] < 1e-13
    assert all(len(s) == 1 for s in signs.values())


@pytest.mark.parametrize("rows, components", [
    ([], 0), ([(1, None)], 0), ([(1, [])], 0), ([(1, [0.5, 0.5])] * 3, 0),
    ([(1, [0.5, 0.5]), (2, [0.0, 0.5])], 1), ([(i, [float(i % 2), float(i // 2)]) for i in range(4)], 2)])
def test_whitening_of_little(spark, rows, components):
    got = whitening.whitened(vectors_of(spark, rows)).collect()
    assert len(got) == components * len(rows)
    assert all(math.isfinite(r["whitened"]) and r["identity_error"] < 1e-9 for r in got)


def test_chebyshev_rounds_separate_close_eigenvalues():
    r = np.random.default_rng(3)
    q = np.linalg.qr(r.standard_normal((60, 60)))[0]
    e = np.concatenate([[1, 0.9, 0.8999, 0.7], np.linspace(0.6995, 0.01, 56)])
    v = (q * e) @ q.T
    passes = [0]

    def times(m):
        passes[0] += 1
        return v @ m

    values, axes, errors, sure = whitening.leading_axes(times, 60, e.sum(), 4)
    assert sure and np.allclose(values, e[:4], atol=1e-13) and passes[0] < 200
    assert np.abs(np.abs((axes * q[:, :4]).sum(axis=0)) - 1).max() < 1e-12
    # Power steps of the same number of passes are far from that.
    p = np.linalg.qr(np.random.default_rng(7).standard_normal((60, 4)))[0]
    for _ in range(passes[0]):
        p = np.linalg.qr(v @ p)[0]
    assert np.linalg.norm(p.T @ q[:, 3]) < 1 - 1e-6


def test_deviation_beyond_a_long_is_null():
    fit = whitening.Fit(1, 2**31, [0], np.ones((1, 1)), np.ones(1), 1.0, np.zeros(1), 0, True)
    assert fit.deviations(np.array([[1], [3], [2**20]])) == [2**62, None, None]


# -- 13 --------------------------------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute_ranks(docs, items, k):
    lists = [terms(t) for _, t in docs]
    n, total = sum(1 for x in lists if x), sum(map(len, lists))
    df = Counter(t for x in lists for t in set(x))
    out = []
    for item_id, text in items:
        own = set(terms(text))
        scored = []
        for (doc_id, _), x in zip(docs, lists):
            tf = Counter(x)
            m = 100 - 50 + (50 * len(x) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in own if t in tf)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id))
        out += [(item_id, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, PASSAGE), (2, None), (3, "..."), (4, "The SAME text"), (4, "the same"), (None, "Σ ß 🙂 la"), (5, "absent123"),
         (6, " ".join(words(30, 6))), (7, " ".join(words(400, 99)) + " la la"), (8, "before after all")]


def searched(spark, docs, items, k, **more):
    items = spark.createDataFrame([(i, t, "d", 5) for i, t in items], "item_id bigint, text string, doc_id string, rank int")
    got = ranked_search.best_documents(docs, items, k, **more)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Enough rows for trees of some depth, with copies that tie."""
    return ODD_ROWS + [(1000 + i, " ".join(words(5 + i % 60, i % 150)) + (" " + PASSAGE if i % 9 == 0 else "")) for i in range(700)]


@pytest.mark.parametrize("k, batch_terms", [(50, ranked_search.BATCH_TERMS), (3, 40)])
def test_ranks_against_brute_force(spark, docs_of, corpus, k, batch_terms):
    assert searched(spark, docs_of(corpus), ITEMS, k, batch_terms=batch_terms) == brute_ranks(corpus, ITEMS, k)


def test_search_of_nothing(spark, docs_of):
    assert searched(spark, docs_of([]), ITEMS, 5) == []
    assert searched(spark, docs_of(ODD_ROWS), [], 5) == []
    assert searched(spark, docs_of([(1, None), (2, "?")]), ITEMS, 5) == []


def _block(rows, items, n_docs):
    b = ranked_search._Block()
    for doc_id, text in rows:
        found = [(items.vocabulary[t], c) for t, c in Counter(ranked_search.terms_of(text.encode())).items() if t in items.vocabulary]
        if found:
            b.ids.append(doc_id)
            b.lengths.append(len(text.split()))
            b.sizes.append(len(found))
            b.terms += [t for t, _ in found]
            b.tfs += [c for _, c in found]
    return ranked_search.Block(b.row(), np.full(len(items.vocabulary), 1000), n_docs, sum(b.lengths))


def test_node_bounds_hold_and_prune():
    texts = [(i, " ".join(words(40, i % 300)) + (" rare alpha beta gamma" if i % 200 == 0 else "")) for i in range(1500)]
    items = ranked_search.Items([(i, i, [t.encode() for t in sorted(set(x.split()))]) for i, x in enumerate(
        ["rare alpha beta gamma", "alpha gamma", " ".join(words(8, 1)), " ".join(words(8, 2))])])
    block = _block(texts, items, len(texts))
    assert block.right[0] > 0 and items.right[0] > 0
    leaves = np.flatnonzero(block.right == 0)
    single = np.flatnonzero(items.right == 0)
    exact = np.concatenate([block.scores(items, leaf, single) for leaf in leaves])
    for node in range(len(block.low)):
        below = exact[block.low[node]:block.high[node]].max(axis=0)
        assert (block.bounds(items, node, single) >= below).all()
        for inner in np.flatnonzero(items.right):
            inside = (items.low[single] >= items.low[inner]) & (items.low[single] < items.high[inner])
            assert block.bounds(items, node, np.array([inner]))[0] >= below[inside].max()
    search = ranked_search.Search(items, 5, {})
    search.block(block)
    again = ranked_search.Search(items, 5, {i: (-b[-1][0], b[-1][2]) for i, b in enumerate(search.best) if len(b) == 5})
    again.block(block)
    assert again.best == search.best and again.scored < search.scored < exact.size and again.pruned
