import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names the operators use inside or return.
CLASHING = ("id", "ids", "fp", "gid", "kept", "spans", "score", "bucket", "value", "key", "block", "u", "size")

WORDS = "der the la und of et zu and le die to un".split()


def odd_texts():
    """Null, empty, blank, very long, repeated and unusual texts."""
    long_text = " ".join(f"{WORDS[i % 12]}{i % 97}" for i in range(30_000))
    return [
        None,
        "",
        " \t\n",
        "one",
        "one",
        "a b c d e f",
        "a  b\tc d\ne f",
        "A B C D E F",
        "x" * 20_000,
        long_text,
        long_text + " more",
        "é ü   漢字 <|endoftext|> 'll 123",
        "\x1c\x1f\x85 ​",
    ]


@pytest.fixture
def odd(spark):
    """Rows with odd texts, null and repeated ids, and columns with clashing names."""
    texts = odd_texts()
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", 0) for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "s", 0), (None, "a b c d e f", "de", None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING:
        df = df.withColumn(name, df["n_chars"])
    return df


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
