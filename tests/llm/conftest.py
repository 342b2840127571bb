import random
import sys
from pathlib import Path

import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SYLLABLES = ["ka", "lo", "mi", "ren", "tus", "ve", "on", "shi", "dar", "pel", "quo", "zu"]


def prose(rng, n, lines=1):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    size = max(1, n // lines)
    return "\n".join(" ".join(words[i:i + size]) + "." for i in range(0, n, size))


@pytest.fixture
def rng():
    return random.Random(17)


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with columns whose names the operators use themselves."""
    def build(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, 0, "k", ["w"], 1, 0.5, 7) for i, t, s in ((*r, "src")[:3] for r in rows)],
            "doc_id long, text string, lang string, source string, n_chars long, key string, words array<string>, rank int, score double, row_key int")
    return build


@pytest.fixture
def odd_rows(rng):
    """NULL ids and texts, empty and blank texts, a repeated row, a repeated text, a very long text, a very long line."""
    long_text = prose(rng, 30_000, 300)
    same = prose(rng, 60, 2)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, same), (5, same), (6, same), (None, prose(rng, 40)), (None, None),
            (7, long_text), (8, prose(rng, 20_000)), (9, "ÉCOLE 中文 ß\x00 \x0b x"), (10, "\n".join(["the very same line of many words again"] * 50))]
