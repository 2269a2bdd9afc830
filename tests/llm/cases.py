"""Small tables that hold the awkward cases, and helpers for brute-force checks."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside, here as columns of the table.
    T.StructField("key", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("h", T.StringType()),
    T.StructField("removed", T.IntegerType()), T.StructField("score", T.StringType()), T.StructField("pos", T.StringType()),
])
EXTRA = ("x", None, "y", 3, "z", "w")

LINES = ["alpha beta gamma delta.", "the second line of it", "and a third one here", "fourth line, a little longer", "the fifth"]


def odd_rows() -> list[tuple]:
    passage = "\n".join(LINES)
    texts = [
        (1, passage, "en", "a"), (2, passage, "en", "a"), (3, "own first line\n" + passage + "\nown last line", "en", "b"),
        (4, None, "en", "b"), (5, "", "de", None), (6, "   \n\n \n ", None, None), (7, "!!! ... 123", "de", "ä"),
        (8, "one", "de", "b"), (9, "A\nA\nA\nA\nA\nA", None, "a"), (10, "über Straße " * 4000, "de", "c"),
        (11, passage + "\n" + passage, "en", "c"), (None, "a row without an id", None, "a"), (None, "another such row", "en", None),
        (12, "same row twice\nwith\nthree lines", "en", "a"), (12, "same row twice\nwith\nthree lines", "en", "a"),
        (13, "same id, first text", "en", "a"), (13, "same id, second text", "en", "a"),
        (14, "Released under the MIT License. Apache License, Version 2.0; CC-BY-NC", "en", "d"), (15, "\x00\x01 odd \x1c bytes", "xx", "d"),
    ]
    return [(i, t, lang, source, None if t is None else len(t), *EXTRA) for i, t, lang, source in texts]


def odd_table(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_table(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)
