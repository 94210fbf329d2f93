"""Small fixtures shared by the tests of the corpus operators."""

import json

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, first=0, lang="en", source="s"):
    """documents rows from a list of texts (ids from ``first``)."""
    return spark.createDataFrame([(first + i, t, lang, source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def with_clashes(df):
    """Extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    names = ("id", "k", "s", "n", "_row", "_t", "_id", "_k", "score", "kept", "shard", "slot", "_tokens_", "component_id", "spans", "a b.c")
    return df.withColumns({n: F.lit("x") for n in names})


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}


def words(n, seed=0, vocab=5000):
    import random

    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocab)}" for _ in range(n)]


__all__ = ["SF", "docs_of", "with_clashes", "table", "by_id", "words", "json"]
