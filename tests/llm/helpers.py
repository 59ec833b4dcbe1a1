"""Small inputs for the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0) for r in rows]
    return spark.createDataFrame(full, DOCS)


def crowded(df, *names):
    """``df`` with extra columns named like the operators' own results."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("x") for n in names})


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def found(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
