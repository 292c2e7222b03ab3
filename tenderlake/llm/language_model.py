"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are words (A-Z lower-cased) and one end for each text.  Counts of all tokens of all training
texts are exact: blocks of documents ask hash ranges for them (see ``blocks``).  They give the base
score, and the base measure p0(w) = (c + 0.1) / (N + 0.1 (V + 1)) of the model.

Model: P(w|h) = (1 - u) P(class of w | h) P(w | class, h) for known words, and u for the unknown token, where u
is the share of training tokens that are a word's only occurrence (Good-Turing).  The HEAD most frequent
words form classes of PER_CLASS by frequency; all other words belong to one of TAILS classes by their ending.
  P(class|h) ~ p0(class) exp(sum of the class weights of h's features)
  P(w|class, h) ~ p0(w) exp(sum of w's weights of h's features), in head classes; p0(w) / p0(class) in the others.
Features are hashed: the word before, the two words before, and by skips the second and the third word before.
For every h the probabilities of all known words and the unknown token add up to 1.

Training: AdaGrad updates on every training text, once.  Blocks are dealt to ROUNDS rounds; in a round each
task starts from the shared weights and updates a copy over its texts; the rows of the weight tables are
averaged by how often tasks saw their feature, in a shuffle by slices of the tables that each
reducer adds up as they come, and are the next round's weights.  Tables have a fixed size, whatever the input: a
limit, as more text makes the counts better but not the tables larger (held-out figures in the README).

Defined results: null text counts as empty: one token, the end.  A null doc_id is neither held out nor
learnt from.  Without training texts N = 0 and both scores are 0.  Repeated rows stay and count each time.
Empty table: empty result.  Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import (BLOCK_CHARS, RANGE_HASHES, WordHashes, arrow_table, by_range, mixed, packed, total_chars, unpacked,
                     unzipped, zipped)
from .shared import map_columns, written

HEAD, PER_CLASS, TAILS = 1024, 64, 32
HEADS = HEAD // PER_CLASS
CLASSES = HEADS + TAILS
CLASS_ROWS, WORD_ROWS = 1 << 14, 1 << 13
ROUNDS, BATCH, RATE = 2, 32_768, 0.25
SLICES = 32
CACHED = 2048
END = b"\n"  # no word holds white space
SMOOTH = 0.1


class WordCodes(WordHashes):
    """64-bit codes of words: a hash whose low bits are the class of the word's ending."""

    def __missing__(self, word: bytes) -> int:
        ending = word.rstrip(b".,;:!?")[-3:]
        code = xxhash.xxh3_64_intdigest(word) & ~(TAILS - 1) | xxhash.xxh3_64_intdigest(ending) % TAILS
        if len(word) <= 64:
            self[word] = code
        return code


CODES = WordCodes()


class Tokens:
    """Tokens of some texts in one row of codes."""

    def __init__(self, texts: list[bytes]):
        words = [t.lower().split() for t in texts]  # bytes: ASCII only
        self._set(CODES.of([x for w in words for x in (*w, END)]), np.array([len(w) + 1 for w in words], np.int64))

    def _set(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes, self.counts = codes, counts
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)

    @classmethod
    def of_codes(cls, codes: np.ndarray, counts: np.ndarray) -> Tokens:
        """Of codes that were made before; counts: of tokens by text."""
        t = cls.__new__(cls)
        t._set(codes, counts)
        return t

    def chosen(self, keep: np.ndarray) -> np.ndarray:
        return keep[self.doc]


def is_training(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known & np.array([zlib.crc32(str(i).encode()) % 10 != 0 for i in ids.tolist()], bool)


# -- counts ------------------------------------------------------------------------------------------------------

ASK = "range bigint, block bigint, hashes binary, values binary"
#: A block's texts as places in the sorted list of its different codes; sizes: tokens of each text.
TOKENS = "block bigint, ids binary, known binary, sizes binary, codes binary, places binary"


def _tokenised(table: pa.Table) -> pa.Table:
    """Texts of a block are cut into words here only; all later steps read the codes."""
    ids, texts, known = unpacked(table)
    t = Tokens(texts)
    codes, places = np.unique(t.codes, return_inverse=True)
    return arrow_table([(table.column("block")[0].as_py(), ids.astype("<i8").tobytes(), known.tobytes(), t.counts.astype("<i8").tobytes(),
                         zipped(codes), zipped(places.astype(np.int32)))], TOKENS)


class Block:
    """A row of the tokenised texts."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.ids, self.counts = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["sizes"], "<i8")
        self.known = np.frombuffer(row["known"], bool)
        self.codes, self.places = unzipped(row["codes"], np.uint64), unzipped(row["places"], np.int32)
        self.train = is_training(self.ids, self.known)

    @staticmethod
    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one at a time
                yield Block(batch.slice(i, 1).to_pylist()[0])


def _ask(n_ranges: int):
    def f(batches):
        for b in Block.rows(batches):
            chosen = np.repeat(b.train, b.counts)
            counts = np.bincount(b.places[chosen], minlength=len(b.codes)).astype(np.int64)
            rows = [(r, b.block, zipped(b.codes[s]), zipped(counts[s])) for r, s in by_range(b.codes, n_ranges)]
            yield from arrow_table(rows, ASK).to_batches()

    return f


def _answer(table: pa.Table) -> pa.Table:
    """Counts over all blocks for each block; and, as block -1, the range's totals by tail class and its most frequent words."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("range", "block", "hashes", "values"))), key=lambda r: r[1])
    asked = [unzipped(r[2], np.uint64) for r in rows]
    codes, group = np.unique(np.concatenate(asked), return_inverse=True)
    counts = np.bincount(group, weights=np.concatenate([unzipped(r[3], np.int64) for r in rows]), minlength=len(codes)).astype(np.int64)
    out = [(r[0], r[1], b"", zipped(a)) for r, a in zip(rows, np.split(counts[group], np.cumsum([len(a) for a in asked])[:-1]))]
    tail = (codes % np.uint64(TAILS)).astype(np.int64)
    totals = np.stack([np.bincount(tail, weights=counts, minlength=TAILS), np.bincount(tail, weights=counts > 0, minlength=TAILS),
                       np.bincount(tail, weights=counts == 1, minlength=TAILS)]).astype("<i8")
    top = np.lexsort((codes, -counts))[:HEAD]
    top = top[counts[top] > 0]
    out.append((rows[0][0], -1, np.stack([codes[top], counts[top].astype(np.uint64)]).astype("<u8").tobytes(), totals.tobytes()))
    return arrow_table(out, ASK)


class Base:
    """Counts that do not grow with the corpus: totals by class, and the head words."""

    def __init__(self, totals: np.ndarray, head: list[tuple[int, int]]):
        """totals: tokens, words and single words by tail class, head words included; head: (code, count)."""
        tokens, words, self.singles = (totals[k].astype(float).copy() for k in range(3))
        self.n, self.v = int(totals[0].sum()), int(totals[1].sum())
        self.z = self.n + SMOOTH * (self.v + 1)
        self.unknown = min(max(self.singles.sum() / self.n, SMOOTH / self.z), 0.5) if self.n else 1.0
        codes = np.array([c for c, _ in head], np.uint64)
        order = np.argsort(codes)
        self.codes, self.rank = codes[order], order.astype(np.int64)  # rank by frequency of the sorted codes
        counts = np.zeros(HEAD)
        counts[:len(head)] = [k for _, k in head]
        for code, k in head:  # head words are in classes of their own
            tokens[code % TAILS] -= k
            words[code % TAILS] -= 1
        mass = np.where(counts > 0, counts + SMOOTH, 0).reshape(HEADS, PER_CLASS)
        with np.errstate(divide="ignore", invalid="ignore"):  # empty classes
            classes = np.log(np.concatenate([mass.sum(axis=1), tokens + SMOOTH * words]) / self.z)
            inside = np.log(mass) - np.log(mass.sum(axis=1))[:, None]
        self.tail_mass = tokens + SMOOTH * words
        self.log_class = np.where(np.isfinite(classes), classes, -1e4).astype("f4")
        self.log_inside = np.where(np.isfinite(inside), inside, -1e4).astype("f4")

    def head_of(self, codes: np.ndarray) -> np.ndarray:
        """Rank of each code among the head words, or -1."""
        if not len(self.codes):
            return np.full(len(codes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.rank[at], -1)


# -- model -------------------------------------------------------------------------------------------------------


class Model:
    """The two weight tables: features x classes, and (feature, class) x words of the class."""

    def __init__(self, base: Base, classes: np.ndarray | None = None, words: np.ndarray | None = None):
        self.base = base
        self.classes = np.zeros((CLASS_ROWS, CLASSES), "f4") if classes is None else classes
        self.words = np.zeros((WORD_ROWS, PER_CLASS), "f4") if words is None else words

    @staticmethod
    def features(t: Tokens) -> np.ndarray:
        """Hashed contexts of every token: the word before, two words before, and two skips."""
        def before(k: int) -> np.ndarray:
            out = np.zeros(len(t.codes), np.uint64)  # 0: before the text's first word
            out[k:] = t.codes[:-k] if k else t.codes
            out[t.place < k] = np.uint64(k)
            return out

        one, two, three = before(1), before(2), before(3)
        with np.errstate(over="ignore"):
            return np.stack([mixed(one + np.uint64(11)), mixed(one * np.uint64(0x9E3779B97F4A7C15) + two),
                             mixed(two + np.uint64(77)), mixed(three + np.uint64(77))])

    def class_part(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the class table, and log P(class|h)."""
        rows = (f % np.uint64(CLASS_ROWS)).astype(np.int32)
        return rows, _log_softmax_of(self.classes, rows, lambda at: self.base.log_class)

    def word_part(self, f: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the word table for head classes c, and log P(.|class, h)."""
        with np.errstate(over="ignore"):
            own = mixed(f[[0, 2]] + c.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        rows = (own % np.uint64(WORD_ROWS)).astype(np.int32)
        return rows, _log_softmax_of(self.words, rows, lambda at: self.base.log_inside[c[at]])

    def update(self, f: np.ndarray, codes: np.ndarray, state: dict) -> None:
        """One gradient step on some tokens."""
        rank = self.base.head_of(codes)
        cls = np.where(rank >= 0, rank // PER_CLASS, HEADS + (codes % np.uint64(TAILS)).astype(np.int64))
        rows, logp = self.class_part(f)
        _step(self.classes, state["classes"], rows, logp, cls)
        at = np.flatnonzero(rank >= 0)
        if len(at):
            rows, logp = self.word_part(f[:, at], cls[at])
            _step(self.words, state["words"], rows, logp, rank[at] % PER_CLASS)

    def log_probabilities(self, t: Tokens, counts: np.ndarray) -> np.ndarray:
        """Natural log of P(token | what stands before it); counts: of the tokens in training."""
        out = np.empty(len(t.codes))
        every = self.features(t)
        for k in range(0, len(out), BATCH):
            f, codes, c = every[:, k:k + BATCH], t.codes[k:k + BATCH], counts[k:k + BATCH]
            rank = self.base.head_of(codes)
            cls = np.where(rank >= 0, rank // PER_CLASS, HEADS + (codes % np.uint64(TAILS)).astype(np.int64))
            _, logp = self.class_part(f)
            p = logp[np.arange(len(cls)), cls].astype(float)
            head, tail = np.flatnonzero(rank >= 0), np.flatnonzero((rank < 0) & (c > 0))
            if len(head):
                _, inside = self.word_part(f[:, head], cls[head])
                p[head] += inside[np.arange(len(head)), rank[head] % PER_CLASS]
            p[tail] += np.log((c[tail] + SMOOTH) / self.base.tail_mass[cls[tail] - HEADS])
            p += np.log1p(-self.base.unknown) if self.base.unknown < 1 else 0.0
            p[c == 0] = np.log(self.base.unknown)
            out[k:k + BATCH] = p
        return out


def _log_softmax_of(table: np.ndarray, rows: np.ndarray, measure) -> np.ndarray:
    """Log softmax of the sums of some rows of a table and the base measure; as many tokens at a time as stay in the cache."""
    n = rows.shape[1]
    out, one, exps = np.empty((n, table.shape[1]), "f4"), np.empty((CACHED, table.shape[1]), "f4"), np.empty((CACHED, table.shape[1]), "f4")
    for k in range(0, n, CACHED):
        at = slice(k, min(k + CACHED, n))
        x, y, e = out[at], one[:at.stop - k], exps[:at.stop - k]
        np.take(table, rows[0, at], axis=0, out=x, mode="clip")
        for r in rows[1:]:
            x += np.take(table, r[at], axis=0, out=y, mode="clip")
        x += measure(at)
        x -= x.max(axis=1, keepdims=True)
        x -= np.log(np.exp(x, out=e).sum(axis=1, keepdims=True))
    return out


def _step(table: np.ndarray, state: dict, rows: np.ndarray, logp: np.ndarray, target: np.ndarray) -> None:
    """AdaGrad on the rows, with the mean gradient of each row's tokens."""
    g = np.exp(logp)
    g[np.arange(len(target)), target] -= 1
    n = len(table)
    times = np.bincount(rows.reshape(-1), minlength=n)
    seen = np.flatnonzero(times)
    place = np.zeros(n, np.int64)
    place[seen] = np.arange(len(seen))
    small, columns = place[rows], np.ascontiguousarray(g.T, dtype="f8")
    sums = np.empty((table.shape[1], len(seen)), "f4")
    for c, column in enumerate(columns):
        sums[c] = sum(np.bincount(r, weights=column, minlength=len(seen)) for r in small)
    total = np.ascontiguousarray(sums.T)
    total /= np.sqrt(times[seen])[:, None]
    squares = state["squares"][seen]
    squares += total * total
    state["squares"][seen] = squares
    squares += 1
    total *= RATE
    total /= np.sqrt(squares, out=squares)
    table[seen] -= total
    state["seen"] += times


# -- training ----------------------------------------------------------------------------------------------------

SLICE = "slice int, weights binary, times binary"
_SHAPES = {"classes": (CLASS_ROWS, CLASSES), "words": (WORD_ROWS, PER_CLASS)}


def _slices(name: str, table: np.ndarray, times: np.ndarray):
    offset = 0 if name == "classes" else SLICES
    for k, at in enumerate(np.array_split(np.arange(len(table)), SLICES)):
        yield offset + k, table[at].astype("<f4").tobytes(), times[at].astype("<i8").tobytes()


def _train_task(shared):
    def run(batches):
        base, weights = shared.value
        model = Model(base, *(w.copy() for w in weights))
        state = {k: {"squares": np.zeros(s, "f4"), "seen": np.zeros(s[0], np.int64)} for k, s in _SHAPES.items()}
        any_text = False
        for b in Block.rows(batches):
            t = Tokens.of_codes(b.codes[b.places[np.repeat(b.train, b.counts)]], b.counts[b.train])
            every = model.features(t)
            for k in range(0, len(t.codes), BATCH):
                any_text = True
                model.update(every[:, k:k + BATCH], t.codes[k:k + BATCH], state)
        if any_text:
            for name in _SHAPES:
                yield pa.RecordBatch.from_pylist(
                    [{"slice": s, "weights": w, "times": n} for s, w, n in _slices(name, getattr(model, name), state[name]["seen"])],
                    schema=pa.schema([("slice", pa.int32()), ("weights", pa.binary()), ("times", pa.binary())]))

    return run


def _add_up(batches):
    """Sums of weights x times and of times by slice, as the rows come."""
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for s, w, n in zip(*(batch.column(c).to_pylist() for c in ("slice", "weights", "times"))):
            times = np.frombuffer(n, "<i8")
            w = np.frombuffer(w, "<f4").reshape(len(times), -1) * times[:, None].astype("f8")
            sums[s] = [w, times] if s not in sums else [sums[s][0] + w, sums[s][1] + times]
    if sums:
        yield pa.RecordBatch.from_pylist(
            [{"slice": s, "weights": (w / np.maximum(n, 1)[:, None]).astype("<f4").tobytes(), "times": n.astype("<i8").tobytes()}
             for s, (w, n) in sums.items()],
            schema=pa.schema([("slice", pa.int32()), ("weights", pa.binary()), ("times", pa.binary())]))


def train(blocks: DataFrame, base: Base, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The weight tables after one pass over all training texts, in ``rounds`` parts."""
    sc = blocks.sparkSession.sparkContext
    weights = {k: np.zeros(s, "f4") for k, s in _SHAPES.items()}
    for turn in range(rounds):
        shared = sc.broadcast((base, (weights["classes"], weights["words"])))  # tables of a fixed size
        rows = (blocks.filter(F.pmod("block", F.lit(rounds)) == turn).mapInArrow(_train_task(shared), SLICE)
                .repartition("slice").mapInArrow(_add_up, SLICE).collect())  # 2 * SLICES rows
        for r in rows:
            name, k = ("classes", r["slice"]) if r["slice"] < SLICES else ("words", r["slice"] - SLICES)
            at = np.array_split(np.arange(_SHAPES[name][0]), SLICES)[k]
            times = np.frombuffer(bytes(r["times"]), "<i8")
            new = np.frombuffer(bytes(r["weights"]), "<f4").reshape(len(times), -1)
            weights[name][at[times > 0]] = new[times > 0]
        shared.unpersist()
    return weights["classes"], weights["words"]


# -- scoring -----------------------------------------------------------------------------------------------------

RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double")


def _score(shared, n_ranges: int):
    def f(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return arrow_table([], RESULT)
        base, weights = shared.value
        b = Block(table.to_pylist()[0])
        tokens, codes, ids, known = Tokens.of_codes(b.codes[b.places], b.counts), b.codes, b.ids, b.known
        counts, got = np.zeros(len(codes), np.int64), dict(zip(answers.column("range").to_pylist(), answers.column("values").to_pylist()))
        for r, s in by_range(codes, n_ranges):
            counts[s] = unzipped(got[r], np.int64)
        c = counts[b.places]
        p = Model(base, *weights).log_probabilities(tokens, c)
        n = len(ids)
        by_doc = lambda x: np.bincount(tokens.doc, weights=x, minlength=n)
        base_score = by_doc(np.log10((c + SMOOTH) / base.z))
        return arrow_table(list(zip(
            [i if k else None for i, k in zip(ids.tolist(), known.tolist())], (known & ~b.train).tolist(), tokens.counts.tolist(),
            by_doc(c > 0).astype(np.int64).tolist(), [base.n] * n, base_score.tolist(), (by_doc(p) / np.log(10)).tolist())), RESULT)

    return f


def score_texts(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    sc = docs.sparkSession.sparkContext
    chars = total_chars(docs)
    n_blocks, n_ranges = chars // BLOCK_CHARS + 1, chars // (6 * RANGE_HASHES) + 1
    blocks = written(packed(docs, n_blocks, null_ids=True).groupBy("block").applyInArrow(_tokenised, TOKENS), "blocks")
    answers = written(blocks.mapInArrow(_ask(n_ranges), ASK).groupBy("range").applyInArrow(_answer, ASK), "counts")
    summary = answers.filter("block < 0")
    # By tail class, three totals; and of each range's most frequent words the HEAD most frequent.
    totals = summary.select("values").mapInArrow(_sum_totals, "totals binary").collect()
    totals = sum((np.frombuffer(bytes(r["totals"]), "<i8").reshape(3, TAILS) for r in totals), np.zeros((3, TAILS), "i8"))
    words = map_head_words(summary).orderBy(F.desc("n"), "code").limit(HEAD).collect()
    base = Base(totals, [(r["code"] % (1 << 64), r["n"]) for r in words])
    weights = train(blocks, base)
    shared = sc.broadcast((base, weights))
    return (blocks.groupBy("block").cogroup(answers.filter("block >= 0").groupBy("block"))
            .applyInArrow(_score(shared, n_ranges), RESULT))


def _sum_totals(batches):
    total = np.zeros((3, TAILS), "i8")
    for batch in batches:
        for v in batch.column("values").to_pylist():
            total = total + np.frombuffer(v, "<i8").reshape(3, TAILS)
    yield pa.RecordBatch.from_pylist([{"totals": total.astype("<i8").tobytes()}], schema=pa.schema([("totals", pa.binary())]))


def map_head_words(summary: DataFrame) -> DataFrame:
    def make():
        def f(batch):
            pairs = [np.frombuffer(h, "<u8").reshape(2, -1) for h in batch.column("hashes").to_pylist()]
            both = np.concatenate(pairs, axis=1)
            return {"code": both[0].astype("<u8").view("<i8"), "n": both[1].astype("i8")}

        return f

    return map_columns(summary.select("hashes"), "code bigint, n bigint", make)
