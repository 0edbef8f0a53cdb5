import pytest
from pyspark.sql import functions as F

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "a quick brown fox jumps over the lazy dog near the old river bank today " * 3000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    prose = " ".join(f"word{i % 37} and{i % 11} the{i}" for i in range(120))
    rows = [
        (1, prose, "en", "s0", 9), (2, prose + " ", "en", "s0", 9), (2, prose + " ", "en", "s0", 9),
        (3, None, "en", "s1", None), (4, "", None, None, 0), (5, " \n\t ", "de", "s1", 4), (None, prose, None, "s0", 9),
        (6, LONG, "en", "s0", len(LONG)), (7, "x" * 100_000, "de", "s2", None), (8, "one two three", None, "s2", 13),
        (9, "\n".join(["The very same long line of text here."] * 4), "en", "s3", 1),
        (10, "the very same long line of text here.  \nother", "en", "s3", 1),
        (11, "\x0b THE very same long line of text here.\r\n", "en", "s3", 1), (None, None, None, None, None),
        (12, "日本語のテキスト é <|endoftext|> ok", "ja", "s4", 3), (13, "\U0001f600" * 50, "en", "s4", 50)]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("id", "key", "row", "hash", "n", "first", "locator", "mix", "mix_key", "kept", "probability", "lines", "words",
                 "spans", "signature", "component", "text_id", "n_words", "place"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
