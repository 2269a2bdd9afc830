"""License scan by diagonal voting. DataFrame functions only.

Every rolling k-gram of a document's words is joined by hash to the positions of the license templates. A match at
document position p and template position q votes for the diagonal p - q. Votes on neighbouring diagonals (a word more
or less) are merged into one span, and a span counts if it covers enough of its template in about its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import lower_ascii, row_key

K = 3
# Words between the diagonals of one span.
DRIFT = 3
COVERAGE = 0.8
_NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_NOT_WORD_AS_WRITTEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

# The phrases that must be found, word for word, and their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Public license notices and the labels that the method adds when a span covers most of one.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction", "mit-grant"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license", "apache-2-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc-notice"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-notice"),
    ("all rights reserved no part of this publication may be reproduced distributed or transmitted in any form", "all-rights-reserved"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the software the software "
     "is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
     "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
     "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
     "arising from out of or in connection with the software or the use or other dealings in the software", "mit-full"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
     "provided as is and the author disclaims all warranties with regard to this software including all implied "
     "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect "
     "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
     "action of contract negligence or other tortious action arising out of or in connection with the use or "
     "performance of this software", "isc"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
     "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
     "notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
     "with the distribution this software is provided by the copyright holders and contributors as is and any express "
     "or implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
     "particular purpose are disclaimed", "bsd-2-full"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
     "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied see the license for the specific language "
     "governing permissions and limitations under the license", "apache-2-header"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option "
     "any later version this program is distributed in the hope that it will be useful but without any warranty "
     "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general "
     "public license for more details", "gpl-3-header"),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
     "compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
     "commercial or non commercial and by any means", "unlicense"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held "
     "liable for any damages arising from the use of this software permission is granted to anyone to use this "
     "software for any purpose including commercial applications and to alter it and redistribute it freely", "zlib"),
)


def _templates(spark: SparkSession) -> DataFrame:
    """One row per template k-gram: a table of fixed size."""
    rows = [(n, label, n < len(BASE), len(words) - K + 1, q, words[q:q + K])
            for n, (phrase, label) in enumerate(BASE + NOTICES) for words in [phrase.split()]
            for q in range(len(words) - K + 1)]
    made = spark.createDataFrame(rows, "template int, label string, base boolean, grams int, q int, gram array<string>")
    return made.select("template", "label", "base", "grams", "q", *[F.col("gram")[k].alias(f"t{k}") for k in range(K)],
                       F.xxhash64(*[F.col("gram")[k] for k in range(K)]).alias("h"))


def words_of(text: F.Column) -> F.Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case; none for NULL."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _NOT_WORD, -1), "")


def word_number(text: F.Column) -> F.Column:
    """How many; capitals are parts of words before they are put in lower case."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _NOT_WORD_AS_WRITTEN, -1), "")).cast("bigint")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    Rows alike in id and text get the same result; NULL and empty texts have no words and no labels. A base phrase counts
    at each place where all its words stand consecutively. A notice counts once if a span of merged
    diagonals covers at least 0.8 of its k-grams. score is the best coverage of any counted label, 0 without one. Texts of any
    length are read whole, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    words = docs.select(row_key(id_col, F.col(text_col)).alias("key"), words_of(F.col(text_col)).alias("words"))
    # The words beside their successors: shifted slices of one array, which needs no function per word.
    shifted = F.arrays_zip(*[(F.slice("words", F.lit(k + 1), F.size("words")) if k else F.col("words")).alias(f"w{k}") for k in range(K)])
    # Outer, because a plain explode makes the planner filter on the whole expression, written out and so split once per word.
    exploded = words.select("key", F.posexplode_outer(shifted).alias("p", "gram"))
    rolled = exploded.select("key", "p", *[F.col("gram")[f"w{k}"].alias(f"w{k}") for k in range(K)]).withColumn(
        "h", F.xxhash64(*[f"w{k}" for k in range(K)]))
    same = F.lit(True)
    for k in range(K):
        same = same & (F.col(f"w{k}") == F.col(f"t{k}"))
    # The templates are a fixed table of some hundred rows.
    votes = (rolled.join(F.broadcast(_templates(spark)), "h").filter(same)
             .select("key", "template", "label", "base", "grams", "q", "p").distinct())

    # Base phrases: all votes of one diagonal.
    lines = (votes.filter("base").groupBy("key", "template", "label", "grams", (F.col("p") - F.col("q")).alias("start"))
             .agg(F.count("*").alias("n")).filter(F.col("n") == F.col("grams")))
    base = lines.groupBy("key").agg(
        F.count("*").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.collect_set("label").alias("base_set"))

    # Notices: neighbouring diagonals merge while they are at most DRIFT apart and their votes overlap or follow each other.
    diagonal = votes.filter("not base").groupBy("key", "template", "label", "grams", (F.col("p") - F.col("q")).alias("d")).agg(
        F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("q").alias("qs"))
    by = Window.partitionBy("key", "template").orderBy("d")
    gap = F.col("d") - F.lag("d").over(by)
    cut = diagonal.withColumn("cut", F.coalesce((gap > DRIFT).cast("int"), F.lit(1)))
    span = cut.withColumn("span", F.sum("cut").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = span.groupBy("key", "template", "label", "grams", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("covered"),
        F.min("low").alias("low"), F.max("high").alias("high"))
    held = merged.withColumn("share", F.col("covered") / F.col("grams")).filter(
        (F.col("share") >= COVERAGE) & (F.col("high") - F.col("low") + 1 <= F.col("grams") * 1.5 + DRIFT))
    notices = held.groupBy("key").agg(F.collect_set("label").alias("notice_set"), F.max("share").alias("best"))

    found = base.join(notices, "key", "full").withColumnRenamed("key", "found")
    light = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, F.col(text_col)).alias("key"),
                        word_number(F.col(text_col)).alias("n_words"))
    empty = F.array().cast("array<string>")
    base_set, notice_set = F.coalesce("base_set", empty), F.coalesce("notice_set", empty)
    joined = light.join(found, F.col("key").eqNullSafe(F.col("found")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"), F.col("last_word").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base_set), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_set, notice_set)), ",").alias("labels"),
        F.when(F.size(base_set) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).cast("double").alias("score"))
