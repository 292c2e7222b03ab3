"""Each operator against brute force on a small table with odd rows, and on an empty one."""

from __future__ import annotations

import hashlib
import json
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import DOCS, LONG, ODD_ROWS, PASSAGE, words
from pyspark.sql import functions as F

from tenderlake.llm import (blocks, bpe, chat, components, exact_dedup, fingerprints, language_model, near_dedup, packing,
                            quality, queries, substrings, url_filter)

SPACE = " \t\n\x0b\x0c\r"
WORD_FILE, BYTE_FILE = queries.tokenizer_file("word_bpe_49k.json"), queries.tokenizer_file("byte_bpe_50k.json")


def split(text):
    return (text or "").encode().split()


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def by_id(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


@pytest.fixture(scope="module")
def odd(docs_of):
    return docs_of(ODD_ROWS)


@pytest.fixture(scope="module")
def none(docs_of):
    return docs_of([])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (7, 1, 0), (15, 0, 0), (10, 1, 0), (None, 1, 0), (12, None, 0)],
                                 "doc_id bigint, quality int, toxic int")


# -- 1 ---------------------------------------------------------------------------------------------------------------


def reference_ids(text, path=WORD_FILE):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_bpe_matches_the_library(odd):
    got = by_id(bpe.encoded_digests(odd, WORD_FILE))
    assert sum(map(len, got.values())) == len(ODD_ROWS)
    for i, t in ODD_ROWS:
        ids, text = reference_ids(t)
        want = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text))
        assert want in [(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got[i]], (i, (t or "")[:40])


def test_bpe_ids_and_decoding(odd):
    encoded = bpe.encode(odd, WORD_FILE)
    texts = by_id(bpe.decode(encoded, WORD_FILE))
    for i, rows in by_id(encoded).items():
        if i is not None and len(rows) == 1:
            want = reference_ids(dict(ODD_ROWS)[i])
            assert (list(rows[0]["ids"]), rows[0]["decoded"]) == want
            assert texts[i][0]["text"] == want[1]


def test_bpe_of_random_words_and_every_token():
    import random
    from tokenizers import Tokenizer
    t, enc, r = Tokenizer.from_file(WORD_FILE), bpe.Encoder(WORD_FILE), random.Random(3)
    texts = ["".join(r.choice("abcdehinorst'ñé1! ") for _ in range(r.randint(1, 16))) for _ in range(5000)]
    back = {c: b for b, c in enumerate(bpe.byte_alphabet())}
    texts += [bytes(back[c] for c in s.removesuffix("</w>")).decode("utf8", "ignore") for s in list(enc.v.ids)[::7]]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g[0], "<u4").tolist() for g in enc.encode(texts)] == want


def test_bpe_cache_starts_afresh_without_changing_results():
    texts = [" ".join(words(300, k)) for k in range(10)]
    small, large = bpe.Encoder(WORD_FILE, cache_limit=350), bpe.Encoder(WORD_FILE)
    for t in texts:
        assert small.encode([t]) == large.encode([t])
        assert len(small.pieces.young) <= 700


# -- 2 ---------------------------------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string, replies int"


def test_chat_reads_back_what_went_in(spark):
    rows = [(1, 0, "system", "s"), (1, 2, "assistant", "b\\h </turn>\n### user: x"), (1, 1, "user", "### Assistant: </turn>"),
            (1, 3, "assistant", ""), (2, 0, "assistant", None), (3, None, None, None), (None, 0, "user", "\\b\\l\\c::"),
            (4, 0, "user", "tie"), (4, 0, "user", "tie"), (4, 0, "assistant", "tie \\# <"), (5, 0, "a: <b>\n", "🙂 long " * 20_000),
            (-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    got = {r["conv_id"]: r for r in chat.chat_digests(turns).collect()}
    for c in {r[0] for r in rows}:
        own = sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c])
        loss = "".join(t for *_, role, t in own if role == "assistant")
        g = got[c]
        assert (g["n_turns"], g["turns_sha256"]) == (len(own), sha("".join(f"{r}\n{t}\n" for *_, r, t in own)))
        assert (g["loss_chars"], g["loss_sha256"]) == (len(loss), sha(loss))
    examples = chat.prefix_targets(chat.format_conversations(turns)).filter("conv_id = 1").orderBy("example").collect()
    assert [e["reply"] for e in examples] == ["b\\h </turn>\n### user: x", ""]
    assert examples[0]["context"] == "### system: s</turn>\n### user: \\h\\h\\h Assistant: \\l/turn></turn>\n### assistant: "
    assert examples[1]["context"].startswith(examples[0]["context"])
    for e in examples:
        assert e["loss_start"] == len(e["context"])
        assert e["formatted"][e["loss_start"] + e["loss_chars"]:].startswith(chat.CLOSE)
    assert [e["turn"] for e in examples] == [2, 3]
    assert not chat.chat_digests(turns.limit(0)).collect()


def test_chat_of_one_very_long_conversation(spark):
    n = 50_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    text = F.concat(F.col("id").cast("string"), F.lit(" # "), F.repeat(F.lit("x"), 200))
    turns = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text.alias("text"))
    got = chat.chat_digests(turns).collect()
    texts = [f"{i} # " + "x" * 200 for i in range(n)]
    assert len(got) == 1 and got[0]["n_turns"] == n
    assert got[0]["turns_sha256"] == sha("".join(f"{'assistant' if i % 2 else 'user'}\n{t}\n" for i, t in enumerate(texts)))
    assert got[0]["loss_sha256"] == sha("".join(texts[1::2]))


def test_chat_examples_hold_context_and_reply(spark):
    """An example's text is the conversation up to its reply's end, also beyond one block of turns; the loss is read from it."""
    n = 2 * chat.BLOCK + 3
    rows = [(1, i, "assistant" if i % 3 else "user", f"é{i}# </turn>\n🙂<") for i in range(n)] + [(2, 0, "user", "none")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    formatted = chat.format_conversations(turns)
    whole = formatted.where("conv_id = 1").first()["formatted"]
    got = chat.prefix_targets(formatted).orderBy("conv_id", "example").collect()
    assert [e["turn"] for e in got] == [*[i for i in range(n) if i % 3], None] and got[-1]["text"] is None
    for e in got[:-1]:
        end = e["loss_start"] + e["loss_chars"]
        assert e["context"] == whole[:e["loss_start"]] and e["text"] == whole[:end + len(chat.CLOSE)]
        assert e["reply"] == rows[e["turn"]][3]
    plan = chat.chat_digests(turns)._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(blocks" in plan  # the digests' examples are made with their contexts


def test_chat_main_path_is_native(spark):
    turns = spark.createDataFrame([(1, 0, "user", "x", "x", 1)], TURNS)
    plan = chat.chat_digests(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- 3 ---------------------------------------------------------------------------------------------------------------


def check_packed(rows, texts, capacity):
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"], r["doc_tokens"]].append(r)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert sorted(seqs) == list(range(len(seqs)))
    want = Counter()
    for i, t in texts:
        ids = [*reference_ids(t, BYTE_FILE)[0], 0]
        for k in range(0, len(ids), capacity):
            p = ids[k:k + capacity]
            want[i, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    return seqs


@pytest.mark.parametrize("capacity", [1024, 64])
def test_packing(odd, capacity):
    check_packed(packing.pack(odd, BYTE_FILE, capacity=capacity).collect(), ODD_ROWS, capacity)


def test_packing_ids_are_the_librarys():
    """Every code point in several places, added tokens, long runs, and the two conditions under which merges by
    smallest new id are the library's merges."""
    import json

    from tokenizers import Tokenizer
    library, own = Tokenizer.from_file(BYTE_FILE), packing.PieceTokenizer(BYTE_FILE)
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x30000, 3), *range(0xE0000, 0xE0200)]]
    texts = [f"a{c}b {c}a1{c}2 .{c} {c}{c}  {c}\n{c} \n{c}'{c}s" for c in points]
    special = "<|endoftext|>"
    texts += [special, f"a {special}  b", f"  {special}\n\n {special}{special} ", special[:-1], f"x\n {special}'s", "", "a" * 50_000,
              " " * 50_000 + "x", "\n " * 50_000, "é" * 30_000, "." * 30_000, "it's we'll I'VE", LONG]
    for k in range(0, len(texts), 10_000):
        part = texts[k:k + 10_000]
        want = library.encode_batch_fast(part, add_special_tokens=False)
        assert [e.ids for e in want] == [own.encode(x).tolist() for x in part]
    model = json.loads(library.to_str())["model"]
    rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
    for token in model["vocab"]:
        parts = list(token)
        while len(parts) > 1 and token != special:
            at = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            assert (parts[at], parts[at + 1]) in rank, token
            parts[at:at + 2] = [parts[at] + parts[at + 1]]


def test_packing_refuses_other_tokenizers():
    with pytest.raises(ValueError):
        packing.PieceTokenizer(WORD_FILE)


def test_packing_pads_little(spark):
    docs = spark.createDataFrame([(k, " ".join(words(20 + 37 * k % 700, k))) for k in range(400)], "doc_id bigint, text string")
    rows = packing.pack(docs.repartition(5), BYTE_FILE).collect()
    full = defaultdict(int)
    for r in rows:
        full[r["sequence_id"]] += r["length"]
    assert sum(1024 - n for n in full.values()) < 0.03 * sum(full.values())


def test_shortest_pack_first_places_every_rank_once():
    histogram = {1: 50, 2: 3, 7: 40, 33: 9, 500: 11, 512: 6, 600: 5, 1000: 4, 1024: 3}
    slots, used = packing.shortest_pack_first(histogram), defaultdict(int)
    ranks = defaultdict(list)
    for length, first, count, sequence, offset in slots:
        ranks[length] += range(first, first + count)
        for k in range(count):
            used[sequence + k] += length
    assert {x: sorted(r) for x, r in ranks.items()} == {x: list(range(n)) for x, n in histogram.items()}
    assert max(used.values()) <= 1024


# -- 4 ---------------------------------------------------------------------------------------------------------------


def brute_repeats(rows, window=13):
    first = {}
    texts = [(i, split(t)) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in texts:
        cut = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k:k + window])] < i:
                cut[k:k + window] = [True] * window
        out.append((i, len(w), sum(cut), sha(b" ".join(x for x, c in zip(w, cut) if not c))))
    return out


def test_repeats_match_brute_force(odd):
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(odd).collect()]
    assert Counter(got) == Counter(brute_repeats(ODD_ROWS))


def test_repeats_at_every_offset_and_length(docs_of, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_CHARS", 3000)  # several blocks and ranges
    monkeypatch.setattr(substrings, "RANGE_HASHES", 100)
    common, rows = words(40, 1), [(0, " ".join(words(5, 2) + words(40, 1) + words(5, 3)))]
    for k in range(60):
        n = 10 + k % 9  # below, at and above a window
        rows.append((k + 1, " ".join(words(k % 11, 100 + k) + common[k % 7:k % 7 + n] + words(k % 5, 300 + k))))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(docs_of(rows)).collect()]
    assert Counter(got) == Counter(brute_repeats(rows))


def test_cover_has_every_difference():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


def test_without_repeats_keeps_clean_texts(odd):
    out = by_id(substrings.without_repeats(odd))
    texts = {i: [r["text"] for r in rs] for i, rs in out.items()}
    assert texts[5] == [dict(ODD_ROWS)[5]] and texts[1] == [None] and texts[3] == [" \t\n"] and texts[8] == [ODD_ROWS[7][1]] * 2
    assert texts[13][0].split() == words(80, 6) + words(40, 7) and texts[14][0].split() == words(50, 8)
    assert texts[11] == ["end"] and 16 not in texts  # 11 holds 10's words, 16 nothing else
    assert out[13][0]["n_chars"] == len(texts[13][0])


# -- 5 ---------------------------------------------------------------------------------------------------------------


def brute_rule(url):
    if "://" not in (url or ""):
        return "", "", None, None
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:at])
    path = rest[at:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))


URLS = ["http://example.com/en/x", "https://WWW.Example.com/en/", "http://a.www.example.com/en/1", "http://example.net/es/1?x=1", "x",
        "http://net/fr/", "http://notexample.com", "http://example.com", "http://ÄX.com/a#b", "ftp://u@h.org:8/p?q#r", "http://net/de/",
        "http://a.b.net/frx/", "a://b://c/d", "http://", "", None, "http://x.com?/en/", "http://comcom/", "https://example.org/" + "9" * 50_000]


def test_urls(spark):
    pages = spark.createDataFrame([(k, u, "h", "x", "y") for k, u in enumerate(URLS)] + [(None, URLS[0], None, None, None), (0, URLS[0], "", "", "")],
                                  "page_id bigint, url string, html string, host string, label string")
    rows = url_filter.judge_urls(pages).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path, rule, verdict = brute_rule(URLS[r["page_id"] or 0])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
    assert not url_filter.judge_urls(pages.limit(0)).collect()


def test_url_trees_learn_the_labels(spark):
    rows = [(k, f"https://{'blog' if k % 3 else 'www'}.s{k % 17}.{'net' if k % 2 else 'com'}/{'es' if k % 4 < 2 else 'en'}/{k}") for k in range(900)]
    rules = [("com", "/", "allow"), ("net", "/", "block")]
    # Urls of the other label that no rule of these decides, but their lexical form does.
    pages = spark.createDataFrame(rows + [(1000 + k, f"https://new.s{k}.{'xnet' if k % 2 else 'xcom'}/en/{k}") for k in range(40)], "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, rules=rules).collect()}
    assert all(got[k]["verdict"] == ("block" if k % 2 else "allow") and got[k]["score"] is None for k, _ in rows)
    assert all(0 <= got[1000 + k]["score"] <= 1 for k in range(40))


def test_copies_of_one_url_do_not_fill_the_sample(spark):
    urls = spark.createDataFrame([(f"http://a{k}.{end}/x",) for k in range(30) for end in ("com", "net/es")], "url string")
    first, *rest = [r["url"] for r in urls.orderBy(F.xxhash64("url")).collect()]
    rows = list(enumerate([first] * 300 + rest + ["http://b.org/x"]))
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string"), train_rows=100, rounds=2, depth=2).collect()
    assert len(got) == len(rows)
    assert [r["score"] is not None for r in got if r["rule"] is None] == [True]


# -- 6 ---------------------------------------------------------------------------------------------------------------


def test_quality_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_quality_of_odd_rows(odd, none, labels, spark):
    got = by_id(quality.classify(odd, labels))
    assert sum(map(len, got.values())) == len(ODD_ROWS)
    for i, rows in got.items():
        for r in rows:
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
            assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
    assert got[1][0]["score"] == got[2][0]["score"]
    assert not quality.classify(none, labels).collect()
    assert {r["score"] for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}


# -- 7 ---------------------------------------------------------------------------------------------------------------


def norm(t):
    import re
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("content_hash", [exact_dedup.md5_bytes, lambda c: F.substring(F.unhex(F.md5(c)), 1, 0)], ids=["md5", "all-collide"])
def test_exact_groups(odd, content_hash):
    groups = defaultdict(list)
    for i, t in ODD_ROWS:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t in ODD_ROWS:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want[i, keep, len(ids), i == keep, sha(norm(t))] += 1
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
                  for r in exact_dedup.exact_dedup(odd, content_hash).collect())
    assert got == want


def test_first_copies_stay(odd, none):
    rows = exact_dedup.keep_first_copies(odd).collect()
    assert sorted(norm(r["text"]) for r in rows) == sorted({norm(t) for _, t in ODD_ROWS})
    assert not exact_dedup.keep_first_copies(none).collect()


# -- 8 ---------------------------------------------------------------------------------------------------------------


def brute_components(rows, width):
    sets = {}
    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = frozenset(tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))) if w else frozenset()
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    smallest = defaultdict(list)
    for k in sets:
        smallest[find(k)].append(rows[k][0])
    out = []
    for k in sets:
        c = min(x for x in smallest[find(k)]) if rows[k][0] is not None else None
        out.append((rows[k][0], len(sets[k]), c, c is None or c == rows[k][0]))
    return out


def near_rows(n=150):
    import random
    r, rows = random.Random(4), []
    for k in range(n):
        base = words(120, 1000 + k % 9)
        for _ in range(r.randint(0, 12)):
            base[r.randrange(len(base))] = f"x{r.randrange(10**6)}"
        rows.append((k * 7 + 3, " ".join(base[:r.choice([120, 118, 100])])))
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_near_components(docs_of, width):
    rows = near_rows() + [r for r in ODD_ROWS if r[1] is None or len(r[1]) < 10_000]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                  for r in near_dedup.near_components(docs_of(rows), width).collect())
    assert got == Counter(brute_components(rows, width))


def test_near_components_through_crowded_regions(docs_of, monkeypatch):
    """Small limits, so that regions go deeper and the rest goes in several blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rows = near_rows(200)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_components(docs_of(rows), 2).collect()}
    assert got == {i: c for i, _, c, _ in brute_components(rows, 2)}


def test_near_empty(none):
    assert not near_dedup.near_components(none).collect()
    assert not near_dedup.keep_one_each(none).collect()


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300), (301, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {k: 0 for k in range(51)} | {k: 100 for k in range(100, 160)} | {300: 300, 301: 300}
    assert got == want


# -- 9 ---------------------------------------------------------------------------------------------------------------


def test_fingerprints_of_edits(docs_of):
    rows = [(k * 300, " ".join(words(5 + 13 * k % 400, k))) for k in range(60)] + [(5, " ".join(words(70, 2))), (6, " ".join(words(70, 2)))]
    got = {r["doc_id"]: r for r in fingerprints.with_edits(docs_of(rows)).collect()}
    rows.sort()
    prints = defaultdict(set)
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        e = t[:len(t) - half] + after[:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), sha(e))
        prints[t].add(got[i]["fingerprint"])
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert got[5]["near_next"] == 1.0
    nears = sorted(r["near_edited"] - r["near_next"] for i, r in got.items() if i != 5)
    assert nears[len(nears) // 10] > 0


def test_fingerprints_of_odd_rows(odd, none, docs_of):
    got = by_id(fingerprints.with_edits(odd))
    assert sum(map(len, got.values())) == len(ODD_ROWS)
    assert got[1][0]["fingerprint"] == got[2][0]["fingerprint"] == "0||"
    assert not fingerprints.with_edits(none).collect()
    alone = fingerprints.with_edits(docs_of([(9, "just one")])).collect()[0]
    assert alone["edited_sha256"] == sha("justjust")


def test_fingerprints_are_native(odd, monkeypatch):
    seen = []
    real = fingerprints.written
    monkeypatch.setattr(fingerprints, "written", lambda df, name: (seen.append(df), real(df, name))[1])
    seen.append(fingerprints.with_edits(odd))
    for df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_every_term_counts_in_long_texts(spark):
    base = sorted(set(words(2400, 41)))[:1500]
    rows = [(k, " ".join(base[:k] + [f"changed{k}"] + base[k + 1:])) for k in range(0, 1500, 50)] + [(-1, " ".join(base))]
    rows += [(-2, " ".join(base[:750] + [f"other{k}" for k in range(750)])), (-3, " ".join(base[:1000])), (-4, " ".join(base[:60]))]
    band = ",".join(["-1"] * (1 << (fingerprints.BUCKET_BITS - 6)))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    prints = docs.select("doc_id", fingerprints.fingerprint(fingerprints.term_hashes(F.col("text")), band).alias("f"))
    one = prints.filter("doc_id = -1").select(F.col("f").alias("g"))
    both = prints.crossJoin(one)
    got = {r[0]: r for r in both.select("doc_id", "f", fingerprints.likeness(F.col("f"), F.col("g")), fingerprints.likeness(F.col("g"), F.col("f"))).collect()}
    assert len({r[1] for r in got.values()}) == len(rows)
    assert all(r[2] == r[3] for r in got.values()) and got[-1][2] == 1
    assert all(0.99 < got[k][2] < 1 for k in got if k >= 0)
    assert got[-2][2] == pytest.approx(1 / 3, abs=0.12)  # 750 of 2,250 terms
    assert 0.4 < got[-3][2] < 0.75  # at the smaller scale, where subsets hold more terms
    assert got[-4][2] < 0.1


# -- 10 --------------------------------------------------------------------------------------------------------------


def test_base_scores(odd, none):
    counts, texts = Counter(), [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in ODD_ROWS]
    for i, w in texts:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(w), sum(x in counts for x in w), n,
                    round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 5)) for i, w in texts)
    rows = language_model.score_texts(odd).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want
    assert all(r["score"] < 0 for r in rows)
    assert not language_model.score_texts(none).collect()


def test_nothing_to_learn_from(docs_of):
    rows = language_model.score_texts(docs_of([(None, "a b"), (None, None)])).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows} == {(0, 0, 0.0, 0.0)}


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in language_model.score_texts(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.9 * sum(r["base_score"] for r in rows)


def test_probabilities_add_up_to_one():
    texts = [" ".join(words(300, k)).encode() for k in range(20)]
    t = language_model.Tokens(texts)
    codes, group = np.unique(t.codes, return_inverse=True)
    counts = np.bincount(group)
    tails = (codes % np.uint64(language_model.TAILS)).astype(int)
    totals = np.stack([np.bincount(tails, weights=w, minlength=language_model.TAILS) for w in (counts, counts > 0, counts == 1)])
    head = sorted(zip(codes.tolist(), counts.tolist()), key=lambda x: (-x[1], x[0]))[:language_model.HEAD]
    base = language_model.Base(totals, head)
    model = language_model.Model(base)
    rng = np.random.default_rng(0)
    model.classes += rng.normal(size=model.classes.shape).astype("f4")
    model.words += rng.normal(size=model.words.shape).astype("f4")
    context = [w for w in texts[3].split()[:3]]
    total = base.unknown
    every = {w for x in texts for w in x.split()}
    one = language_model.Tokens([b" ".join([*context, w]) for w in every] + [b" ".join(context)])
    c = dict(zip(codes.tolist(), counts.tolist()))
    p = np.exp(model.log_probabilities(one, np.array([c[x] for x in one.codes.tolist()])))
    assert total + p[one.place == 3].sum() == pytest.approx(1.0, abs=1e-4)


def test_words_up_to_rank_1024_learn_inside_their_class():
    every = sorted(set(words(1500, 31)))[:1000]
    t = language_model.Tokens([" ".join(every).encode()] * 20)
    codes, counts = np.unique(t.codes, return_counts=True)
    tails = (codes % np.uint64(language_model.TAILS)).astype(int)
    totals = np.stack([np.bincount(tails, weights=w, minlength=language_model.TAILS) for w in (counts, counts > 0, counts == 1)])
    base = language_model.Base(totals, sorted(zip(codes.tolist(), counts.tolist()), key=lambda x: (-x[1], x[0]))[:language_model.HEAD])
    model = language_model.Model(base)
    state = {k: {"squares": np.zeros(s, "f4"), "seen": np.zeros(s[0], np.int64)} for k, s in language_model._SHAPES.items()}
    f, rank = model.features(t), base.head_of(t.codes)
    for _ in range(5):
        model.update(f, t.codes, state)
    late = np.flatnonzero(rank >= 512)
    assert len(late) >= 20 * 400
    _, inside = model.word_part(f[:, late], rank[late] // language_model.PER_CLASS)
    got = inside[np.arange(len(late)), rank[late] % language_model.PER_CLASS]
    assert got.mean() > base.log_inside.reshape(-1)[rank[late]].mean() + 0.5


# -- shared ----------------------------------------------------------------------------------------------------------


def test_window_hashes_agree_with_their_words():
    h = np.arange(40, dtype=np.uint64) % np.uint64(9)
    for width in range(1, 20):
        got = blocks.window_hashes(h, width)
        keys = [tuple(h[k:k + width].tolist()) for k in range(len(h) - width + 1)]
        assert len(got) == len(keys) and len(set(zip(keys, got.tolist()))) == len(set(keys)) == len(set(got.tolist()))


def test_arrays_come_back():
    rng = np.random.default_rng(1)
    for a in (np.sort(rng.integers(0, 2**63, 100).astype(np.uint64)), np.array([0, 2**64 - 1], np.uint64), np.arange(5), np.zeros(0, np.uint64)):
        assert (blocks.unzipped(blocks.zipped(a), a.dtype) == a).all()


def test_registered_queries_run_on_an_empty_folder(spark, tmp_path):
    """Every query on tables without rows."""
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "pages", "labels", "conversations", "embeddings", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, f in queries.queries().items():
        rows = f(spark, str(tmp_path)).collect()
        assert len(rows) == (1 if name == "op2_chat_formatting" else 0), name


def test_oracle_names():
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert json.dumps(sorted(queries.queries()))
    assert [n for n in queries.queries() if not n.startswith("op")] == []
    assert LONG and PASSAGE and DOCS


def test_language_model_reads_codes_that_were_made_once():
    import pyarrow as pa
    import zstandard
    texts = ["b  B c".encode(), b"", "c É a".encode()]
    row = {"block": 3, "ids": np.array([5, 2, 10], "<i8").tobytes(), "sizes": np.array([len(x) for x in texts], "<i8").tobytes(),
           "texts": zstandard.ZstdCompressor().compress(b"".join(texts)), "known": True}
    made = language_model._tokenised(pa.Table.from_pylist([row]))
    assert made.num_rows == 1 and "texts" not in made.column_names  # later steps have no texts to cut again
    block, = language_model.Block.rows(made.to_batches())
    want = language_model.Tokens([texts[1], texts[0], texts[2]])  # by id
    got = language_model.Tokens.of_codes(block.codes[block.places], block.counts)
    assert block.block == 3 and block.ids.tolist() == [2, 5, 10] and block.known.all()
    for name in ("codes", "counts", "doc", "place"):
        assert np.array_equal(getattr(got, name), getattr(want, name)), name
    assert block.train.tolist() == language_model.is_training(block.ids, block.known).tolist()
