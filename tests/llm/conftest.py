from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table, with extra columns whose names the operators use themselves."""
    def make(rows):
        full = [(i, t, "en", "src", len(t or ""), "x", True, 7, "n", "s") for i, t in rows]
        return spark.createDataFrame(
            full, DOCS + ", keep_id string, kept boolean, node int, signature string, score string").repartition(3)

    return make


def words(n, seed=0):
    """n words of an invented vocabulary, the same for the same seed."""
    import random
    r = random.Random(seed)
    return ["".join(r.choice("aeioustrnl") for _ in range(r.randint(2, 9))) for _ in range(n)]


#: Ids with texts that every operator must stand: null, empty, white space, one word, odd
#: characters, ties, repeated rows, a null id, and a very long text.
LONG = " ".join(words(30_000, 99))
PASSAGE = " ".join(words(60, 5))
ODD_ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "\x00 \x1f\x85 a\u3000b ÀÉ ß Σ ẞ 🙂 e\u0301"), (6, "<|endoftext|> </turn> ### \\n"),
    (7, "the same text here"), (8, "the  same\ntext here"), (8, "the  same\ntext here"), (9, "The same text here"),
    (None, "the same text here"), (None, None), (10, LONG), (11, LONG + " end"), (12, PASSAGE),
    (13, " ".join(words(80, 6)) + " " + PASSAGE + " " + " ".join(words(40, 7))), (14, " ".join(words(50, 8)) + "\n" + PASSAGE.replace(" ", "  ")),
    (15, "la " * 400), (16, "la " * 400), (-3, "before all others"), (2**62, "after all others"),
]
