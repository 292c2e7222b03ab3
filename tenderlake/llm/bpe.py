"""BPE encoding over a trie of distinct words that share their prefixes, and decoding.

The BPE encoding of a string has two properties: dropping its last token leaves
the encoding of the rest, and a token sequence is an encoding when every
neighbouring pair in it is one.  So for each prefix of a word it is enough to know the
*last token* of the prefix's encoding: the token t that ends there and
whose pair with the last token before t is compatible.  A task inserts the
distinct words of a batch into a trie and walks it depth first; each node gets
its last token from the nodes above it, so a prefix that many words share is
encoded once.  Following the last tokens back gives a word's ids.

Documents stay in their partitions: nothing is shuffled, collected or broadcast.
A Python worker keeps the encodings of the words and the white-space separated pieces it
has met lately, ``CACHE_LIMIT`` of them in each of two generations, so its memory is
bounded for any vocabulary.

The vocabulary is a tokenizers JSON file (byte-level BPE with an end-of-word
suffix; NFC, lower case; white space dropped), given by path.

Defined results: null text counts as empty and has no ids, decoding to ''.  Texts of any
length are whole.  Special tokens inside a text become their ids, as in the
tokenizers library.  Repeated rows stay; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Learned, blocks, map_columns

#: What the file's `\s` means: Unicode white space.  Fixed values.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that str.split() takes for white space and the file does not.
NOT_WHITE = re.compile("[\x1c-\x1f]")
CACHE_LIMIT = 300_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (c for c in range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merge ranks, and for each token the parts that its two edges went through while it grew."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> left, right, rank
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.ids[a], self.ids[b]
            self.rank[pair] = rank
            self.parts.setdefault(self.ids[a + b], (*pair, rank))
        self._edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}

    def edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """Tokens that stood at this edge of ``token`` while it grew, each with
        the rank of the merge that took it up (infinite for the token itself)."""
        if (token, right) not in self._edges:
            out, until, t = [], 1 << 60, token
            while True:
                out.append((t, until))
                if t not in self.parts:
                    break
                left, r, until = self.parts[t]
                t = r if right else left
            self._edges[token, right] = out
        return self._edges[token, right]

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border between ``a`` and ``b``.

        A merge of two tokens at the border happens if its rank comes before the
        ranks that take either of them up; of equal ranks the one further left goes first.
        """
        rank = self.rank
        for x, x_until in self.edge(a, True):
            for y, y_until in self.edge(b, False):
                r = rank.get((x, y))
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True


class State:
    """The longest end of a path that begins a token, with the steps taken from it so far."""

    __slots__ = ("text", "inner", "final")

    def __init__(self, text: str):
        self.text, self.inner, self.final = text, {}, {}


class Trie:
    """Encodes sets of words, given in the byte alphabet.

    The sorted distinct words are the trie's leaves in depth-first order: what a
    word shares with the word before it is the path that both have in common, whose
    last tokens stay; only nodes below the fork are worked out.
    """

    def __init__(self, vocabulary: Vocabulary, pair_limit: int = 1_000_000):
        self.v = vocabulary
        self.prefixes = {t[:k] for t in vocabulary.ids for k in range(1, len(t.removesuffix(vocabulary.suffix)) + 1)}
        self.pair_limit = pair_limit
        self._is_whole: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.states = {"": State("")}
        self.after: dict[int, dict[int, bool]] = {}  # token -> token before it -> whether they are compatible
        self.known = 0

    def _step(self, state: State, char: str, final: bool) -> tuple:
        """Over a symbol: the next state, and the tokens that end there, longest first, as
        (token, symbols, what is known of tokens before it)."""
        text, ids, cut = state.text + char + (self.v.suffix if final else ""), self.v.ids, len(self.v.suffix) if final else 0
        ends = tuple((t, len(text) - k - cut, self.after.setdefault(t, {})) for k in range(len(state.text) + 1)
                     if (t := ids.get(text[k:])) is not None and self._whole(t))
        then = None
        if not final:
            key = next((text[k:] for k in range(len(text)) if text[k:] in self.prefixes), "")
            then = self.states.setdefault(key, None) or State(key)
            self.states[key] = then
        (state.final if final else state.inner)[char] = step = (then, ends)
        self.known += 1
        return step

    def _whole(self, token: int) -> bool:
        """Whether the token's own string is encoded as this one token."""
        if token not in self.v.parts:
            return True
        if token not in self._is_whole:
            a, b, rank = self.v.parts[token]
            # Its two parts must come about by themselves and be the first that merge over their border.
            clash = any((r := self.v.rank.get((x, y))) is not None and (x, y) != (a, b) and r < min(xu, rank) and r <= yu
                        for x, xu in self.v.edge(a, True) for y, yu in self.v.edge(b, False))
            self._is_whole[token] = not clash and self._whole(a) and self._whole(b)
        return self._is_whole[token]

    def encode(self, words: set[str]) -> dict[str, list[int]]:
        """ids of each non-empty word."""
        if self.known > self.pair_limit:
            self._forget()
        out: dict[str, list[int]] = {}
        lasts, width, states = [-1], [0], [self.states[""]]  # of the prefixes of the path, by length
        path = ""
        for word in sorted(words):
            n = len(word) - 1
            fork, most = 0, min(len(path), n)
            while fork < most and path[fork] == word[fork]:
                fork += 1
            if fork < len(path):
                del lasts[fork + 1:], width[fork + 1:], states[fork + 1:]
            state = states[fork]
            for depth in range(fork, n + 1):
                char = word[depth]
                if depth < n:
                    step = state.inner.get(char) or self._step(state, char, False)
                else:
                    step = state.final.get(char) or self._step(state, char, True)
                for token, symbols, known in step[1]:
                    before = depth + 1 - symbols
                    if not before:
                        break
                    last = lasts[before]
                    good = known.get(last)
                    if good is None:
                        good = known[last] = self.v.compatible(last, token)
                        self.known += 1
                    if good:
                        break
                else:
                    raise AssertionError("every byte is a token")
                if depth < n:
                    state = step[0]
                    lasts.append(token)
                    width.append(symbols)
                    states.append(state)
                else:
                    ids, at = [token], before
                    while at:
                        ids.append(lasts[at])
                        at -= width[at]
                    ids.reverse()
                    out[word] = ids
            path = word[:n]
        return out


class Encoder:
    """Texts to ids and decoded text; one in each Python worker."""

    def __init__(self, path: str, cache_limit: int = CACHE_LIMIT):
        import regex
        self.v = Vocabulary(path)
        self.trie = Trie(self.v)
        self.word = regex.compile(self.v.pattern)
        self.special = re.compile("|".join(f"({re.escape(s)})" for s in self.v.special)) if self.v.special else None
        self.white = re.compile(f"[{WHITE}]+")
        self.shown = dict(enumerate(byte_alphabet()))
        self.words = Learned(cache_limit)  # word -> (ids' bytes, decoded)
        self.pieces = Learned(cache_limit)  # the same for white-space separated pieces

    def split(self, text: str) -> list[str]:
        if NOT_WHITE.search(text):
            return [p for p in self.white.split(text) if p]
        return text.split()

    def _words(self, piece: str) -> list[str]:
        """The words of a piece without white space; special tokens as they stand."""
        if "<|" in piece and self.special:
            parts = [p for p in self.special.split(piece) if p]
            return [w for p in parts for w in ([p] if p in self.v.special else self._plain_words(p))]
        return self._plain_words(piece)

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self.word.findall(text.lower())
        return self.word.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())  # each character by itself

    def _learn_words(self, words: set[str]) -> dict[str, tuple[bytes, str]]:
        strings, special = self.v.strings, self.v.special
        shown = {w: w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.shown)
                 for w in words if w not in special}
        ids = self.trie.encode(set(shown.values()))
        out = {}
        for w in words:
            got = ids[shown[w]] if w in shown else [special[w]]
            out[w] = array("I", got).tobytes(), " ".join([strings[i] for i in got])
        return out

    def _learn(self, pieces: set[str]) -> dict[str, tuple[bytes, str]]:
        """Encodings of pieces that are not known yet; the distinct words in them go through one trie."""
        split = {p: self._words(p) for p in pieces}
        known = self.words.provide(set().union(*split.values()), self._learn_words)
        out = {}
        for p, ws in split.items():
            if len(ws) == 1:
                out[p] = known[ws[0]]
            else:
                got = [known[w] for w in ws]
                out[p] = b"".join([g[0] for g in got]), " ".join([g[1] for g in got])
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """ids as little-endian 32-bit integers and the decoded text of each text."""
        split = [self.split(t) for t in texts]
        known = self.pieces.provide(set().union(*split), self._learn).__getitem__
        out = []
        for pieces in split:
            got = list(map(known, pieces))
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[0]])))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This Python worker's encoder; what it holds follows from the file and the words alone."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string)."""
    def make():
        enc = encoder(path)

        def f(batch):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            got = [g for run in blocks(texts) for g in enc.encode(run)]
            return {"doc_id": batch.column("doc_id"), "ids": [np.frombuffer(g[0], "<u4").astype("i4") for g in got],
                    "decoded": [g[1] for g in got]}

        return f

    return map_columns(_input(docs), "doc_id bigint, ids array<int>, decoded string", make)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the tokens' strings with a space between, special tokens too."""
    def make():
        strings = Vocabulary(path).strings
        return lambda batch: {"doc_id": batch.column("doc_id"),
                              "text": [" ".join(map(strings.__getitem__, ids or [])) for ids in batch.column("ids").to_pylist()]}

    return map_columns(encoded.select("doc_id", "ids"), "doc_id bigint, text string", make)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode`` with its columns
    reduced to digests before they leave the task."""
    def make():
        enc = encoder(path)

        def f(batch):
            n, ids, decoded = [], [], []
            for run in blocks([t or "" for t in batch.column("text").to_pylist()]):
                for raw, text in enc.encode(run):
                    n.append(len(raw) // 4)
                    ids.append(hashlib.sha256(raw).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
            return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

        return f

    return map_columns(_input(docs), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
