import random

import pytest
from pyspark.sql import types as T

# Columns that clash with names that the operators use or return.
_EXTRA = ("n_words", "kept", "score", "shard", "size", "key", "th", "sid", "n", "chunk", "ids", "component_id", "sketch", "row")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in _EXTRA]])
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "nu", "re", "sa", "to") for b in ("", "n", "rin", "sel", "dova", "é", "thing")]


def prose(rng, n, lines=12):
    words = [rng.choice(VOCABULARY) for _ in range(n)]
    return "\n".join(" ".join(words[k:k + lines]) + "." for k in range(0, n, lines))


def awkward_rows():
    """Nulls in every column, empty and wordless texts, a very long text,
    exact and near copies, ties and repeated rows."""
    rng = random.Random(5)
    rows = [(k, prose(rng, rng.randint(60, 220)), "en" if k % 3 else None) for k in range(40)]
    long = prose(rng, 40_000)
    first = rows[0][1]
    words = first.split(" ")
    near = " ".join(words[:30] + ["changed"] + words[31:])
    rows += [(100, None, "en"), (101, "", "en"), (102, " \n\t ", None), (103, long, "fr"), (104, first, "en"), (104, first, "en"),
             (105, near, "de"), (106, "one two", "en"), (107, "One  TWO", "en"), (None, first, "en"), (None, None, None),
             (5, rows[9][1] + " end", "en"), (108, "## ** $$ " * 60, "en"), (109, "same line here\n" * 30, "en"),
             (110, "<|endoftext|> it's we'll  x 🙂 ▁▁ 中文" * 20, "zz")]
    return [(i, t, lang, None, *["x"] * len(_EXTRA)) for i, t, lang in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = awkward_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), rows


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
