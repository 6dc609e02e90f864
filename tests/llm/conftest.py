import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Odd and ordinary texts: null, empty, blanks, marks, other scripts, long runs, repeated rows."""
    rnd = random.Random(3)
    out = [
        None, "", " ", "   ", "a", " a ", "a  b", "a\n b", "a\n \nb", "it's we'll", "<|endoftext|>a<|endoftext|> b",
        "<s>x</s> <0x41>", "日本語 テスト😀 é", "\x01 \x1c a", "\t\ta\t b", "a" * 3000, "ab" * 9000, "123 456,7.8% $$$",
        "a\r\nb \r\n c", "\N{LOWER ONE EIGHTH BLOCK} mark", "dup dup dup dup dup", "dup dup dup dup dup",
        "x\N{NO-BREAK SPACE}y", "x \N{IDEOGRAPHIC SPACE} y", "\N{REPLACEMENT CHARACTER} z",
    ]
    letters = list("aeioutn  \n\t.,'0123456789Éßñ-s") + ["'s", "  ", " \n", "the", "ing", "\N{NEXT LINE}", "日"]
    out += ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(400)]
    return out


@pytest.fixture(scope="session")
def documents(spark, texts):
    """Texts with ids, and columns whose names clash with what operators add."""
    rows = [(i, t, i * 2, "x", 0.5) for i, t in enumerate(texts)] + [(None, "no id", 1, "x", 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, score string, component_id double")
