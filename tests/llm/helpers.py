"""Tables made by hand for the operators' tests."""

from __future__ import annotations

import hashlib

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first=0):
    """Documents with the given texts; a text may come with its id or its source."""
    rows = []
    for i, t in enumerate(texts):
        id_, text, source = (t if isinstance(t, tuple) else (first + i, t, "s"))
        rows.append((id_, text, "en", source, len(text) if text is not None else None))
    return spark.createDataFrame(rows, DOCS)


def digest(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def clashing(df):
    """The rows with more columns, named like those the operators make."""
    from pyspark.sql import functions as F

    names = ["id", "row", "n", "key", "rank", "region", "set", "size", "spans", "_spans", "_base", "label", "kept", "place", "copies", "runs"]
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


def rows(df, *names):
    """The rows as sorted tuples of the named columns, nulls last."""
    found = [tuple(r[n] for n in names or df.columns) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))
