import random

import pytest
from pyspark.sql import types as T

SPACES = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and blank texts, a long text, ties, repeated rows, clashing column names."""
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "éau", "ñandú", "straße", "x", "42", "the", "of", "<|endoftext|>", "🙂"]
    texts = [None, "", " ", "\n\t", "one", "One two", "one two three", "日本語", "1234 !!", "a  b", "a b", "a\tb", " lead", "trail "]
    for _ in range(60):
        texts.append("".join(rnd.choice(words) + rnd.choice(SPACES) for _ in range(rnd.randint(1, 40))))
    texts += texts[20:30] + [texts[30]] * 5 + ["word " * 30_000]
    rows = [(i, t, ["en", "de", None][i % 3], "s", 1, "d", 7, "x") for i, t in enumerate(texts)]
    rows += [(None, "no id", "en", None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    rows += [rows[25], rows[25], rows[2]]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("digest", T.StringType()),
        T.StructField("id", T.LongType()), T.StructField("fp", T.StringType())])).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
