"""Rows that the tests of the package share."""

from __future__ import annotations

from pyspark.sql import types as T

#: Extra columns whose names the operators use themselves.
EXTRA = ("_row", "_w", "words", "kept", "fp", "h", "bytes", "size", "start", "body", "key", "_text", "rule", "node", "label")


def documents(spark, rows):
    """A documents table with clashing extra columns; rows are (doc_id, text, source)."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            *[T.StructField(c, T.StringType()) for c in EXTRA],
        ]
    )
    data = [(i, t, "en", s, None if t is None else len(t), *[f"x{i}"] * len(EXTRA)) for i, t, s in rows]
    return spark.createDataFrame(data, schema)


def pages(spark, rows):
    schema = T.StructType(
        [
            T.StructField("page_id", T.LongType()),
            T.StructField("url", T.StringType()),
            T.StructField("html", T.StringType()),
            *[T.StructField(c, T.StringType()) for c in EXTRA],
        ]
    )
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], schema)


def prose(seed: int, n: int) -> str:
    """Invented words, different for each seed."""
    out, state = [], seed * 7919 + 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append("".join("aeioubcdfg"[(state >> k) % 10] for k in (3, 7, 11, 15, 19)))
    return " ".join(out)


AWKWARD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (None, prose(5, 60), "b"),
    (None, None, None),
    (7, prose(7, 80), "b"),
    (7, prose(7, 80), "b"),
    (8, prose(7, 80), "a"),
    (9, "word", "a"),
    (10, "a b a b a b a b " * 40, "c"),
    (11, prose(11, 30_000), "c"),
    (12, "one  two three\x85four \x1cfive", "a"),
]
