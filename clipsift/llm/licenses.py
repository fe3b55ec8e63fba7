"""License scan by diagonal voting, as DataFrame functions only.

Every text's words are cut into rolling k-grams, whose hashes meet the positions of all license
templates in one join. A match votes for its diagonal (place in the text minus place in the
template); neighbouring diagonals, which inserted or missing words set apart, are merged, and a
merged span counts if the words that its matches cover are enough of the template and hold the
template's key phrase. A second, plainer reading counts three fixed phrases.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipsift.llm.common import text_of
from clipsift.session import durable

GRAM = 3  # words
GAP = 3  # words that merged diagonals may lie apart
COVER_PCT = 80  # words of a template that a span has to cover
MAX_TEMPLATE_WORDS = 100_000  # up to here the template positions are sent to every task
BASE_SCORE = 0.5  # of a text that only holds a fixed phrase
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are lower-cased
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KELVIN = "K"  # the one other character whose lower case is an ASCII letter


@dataclass(frozen=True)
class Template:
    """A license notice; ``key`` is the phrase in it that tells it from others."""

    label: str
    key: str
    text: str


# The wording of common license notices.
TEMPLATES = (
    Template("mit", "mit license", "Released under the MIT License"),
    Template("mit", "mit license", "This project is licensed under the MIT License"),
    Template("mit", "mit license", "Licensed under the MIT License"),
    Template("mit", "permission is hereby granted free of charge", (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions of the Software.")),
    Template("apache", "apache license", "Licensed under the Apache License, Version 2.0"),
    Template("apache", "apache license", (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License.")),
    Template("gpl", "gnu general public license", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "gnu general public license", "Licensed under the GNU General Public License"),
    Template("gpl", "gnu general public license", (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.")),
    Template("lgpl", "gnu lesser general public license", (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)"
        " any later version.")),
    Template("lgpl", "gnu lesser general public license", "Licensed under the GNU Lesser General Public License"),
    Template("agpl", "gnu affero general public license", "Licensed under the GNU Affero General Public License"),
    Template("bsd", "redistribution and use in source and binary forms", (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
        " conditions and the following disclaimer.")),
    Template("bsd", "bsd license", "Licensed under the BSD License"),
    Template("bsd", "bsd license", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file BSD License"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.")),
    Template("mpl", "mozilla public license", (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.")),
    Template("zlib", "without any express or implied warranty", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software.")),
    Template("unlicense", "released into the public domain", "This is free and unencumbered software released into the public domain"),
    Template("cc-by", "cc by 4 0", "Licensed under CC BY 4.0"),
    Template("cc-by-sa", "cc by sa 4 0", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-nc", "cc by nc 4 0", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nd", "cc by nd 4 0", "Licensed under CC BY-ND 4.0"),
    Template("cc-by-nc-sa", "cc by nc sa 4 0", "Licensed under CC BY-NC-SA 4.0"),
    Template("cc-by", "creative commons attribution 4 0 international license",
             "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "attribution sharealike 4 0 international license",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc-by-nc", "attribution noncommercial 4 0 international license",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)


def words_of(text: Column) -> Column:
    """Runs of digits, letters and anything beyond ASCII, A-Z lower-cased."""
    # Spark's lower() reads ASCII texts fast, and changes no other character into an ASCII one but the Kelvin sign.
    low = F.when(F.contains(text, F.lit(KELVIN)), F.translate(text, CAPITALS, CAPITALS.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(low, BETWEEN), "")


def _plain_words(text: str) -> list[str]:
    low = "".join(c if ("a" <= c <= "z" or "0" <= c <= "9" or c > "\x7f") else " " for c in text.lower())
    return low.split(" ") if " " not in low else [w for w in low.split(" ") if w]


def template_positions(spark: SparkSession, templates: Sequence[Template], gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(t_gram, t_hash, template, t_at) of every k-gram, and (template, label, t_len, t_key) of every template."""
    grams, whole = [], []
    for number, one in enumerate(templates):
        words, key = _plain_words(one.text), _plain_words(one.key)
        starts = [i for i in range(len(words)) if words[i : i + len(key)] == key]
        if len(words) <= max(gram, GAP) or not starts:
            raise ValueError(f"template {number} ({one.label}) is too short or lacks its key phrase")
        whole.append((number, one.label, len(words), list(range(starts[0], starts[0] + len(key)))))
        grams += [(words[i : i + gram], number, i) for i in range(len(words) - gram + 1)]
    positions = spark.createDataFrame(grams, "t_gram array<string>, template int, t_at int")
    hashed = positions.withColumn("t_hash", F.xxhash64(*[F.get("t_gram", F.lit(i)) for i in range(gram)]))
    if sum(x[2] for x in whole) <= MAX_TEMPLATE_WORDS:
        hashed = F.broadcast(hashed)
    return hashed, spark.createDataFrame(whole, "template int, label string, t_len int, t_key array<int>")


def _phrases(words: Column) -> Column:
    """(label, start) of each place of "mit license", "apache license" and "general public license"."""
    def word(i: Column) -> Column:
        return F.get(words, i)

    ends = F.filter(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: (word(i) == "license") & (
            word(i - 1).isin("mit", "apache") | ((word(i - 1) == "public") & (word(i - 2) == "general"))
        ),
    )
    return F.transform(ends, lambda i: F.struct(
        F.when(word(i - 1) == "public", "gpl").otherwise(word(i - 1)).alias("label"),
        F.when(word(i - 1) == "public", i - 2).otherwise(i - 1).cast("long").alias("start"),
    ))


def scan_licenses(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, gram: int = GRAM, gap: int = GAP, cover_pct: int = COVER_PCT,
) -> DataFrame:
    """Licenses that every whole text names or holds.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels (the fixed phrases: places,
    smallest and largest start, labels), spans (label, first, words, share of the template, of each
    verified span), labels (both, distinct, sorted, comma-joined) and score: the largest share of a
    template that a span covers, verified or not, and at least ``BASE_SCORE`` with a fixed phrase.

    A null or empty text has no words and no labels. Null and repeated doc_ids are judged row by
    row, whole repeats once for all of them; an empty table gives no rows; other columns are not
    read. Texts shorter than ``gram`` words have no k-grams. Only matches leave a text's row.
    """
    spark = docs.sparkSession
    positions, whole = template_positions(spark, templates, gram)
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("t"))
    rows = rows.select(
        "doc_id", F.xxhash64(own, F.col("doc_id").isNull(), "t").alias("k1"), F.xxhash64("t", own).alias("k2"),
        F.contains(F.lower("t"), F.lit("license")).alias("told"), words_of(F.col("t")).alias("w"),
    )
    none = F.array().cast("array<struct<label:string,start:bigint>>")
    rows = rows.withColumn("b", F.when(F.col("told"), _phrases(F.col("w"))).otherwise(none))
    grams = F.when(F.size("w") >= gram, F.transform(
        F.sequence(F.lit(0), F.size("w") - gram),
        lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get("w", i + j) for j in range(gram)]).alias("h")),
    )).otherwise(F.array().cast("array<struct<at:int,h:bigint>>"))
    header = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("long").alias("h")))
    every = rows.select(
        "doc_id", "k1", "k2", "w", F.size("w").cast("long").alias("n_words"), "b", F.explode(F.concat(header, grams)).alias("g")
    )
    # One row a text, and one for each k-gram that stands in a template, word for word.
    first = F.col("g.at") < 0
    same = F.slice("w", F.greatest(F.col("g.at") + 1, F.lit(1)), gram) == F.col("t_gram")
    marks = every.join(positions, F.col("g.h") == F.col("t_hash"), "left").filter(first | (F.col("template").isNotNull() & same))
    marks = durable(marks.select(
        "k1", "k2", F.col("g.at").alias("at"), "template", "t_at",
        F.when(first, F.struct("doc_id", "n_words", "b")).alias("row"),
    ), "license-marks")

    # Whole repeats of a row vote once, as sets.
    hits = marks.filter("at >= 0").withColumn("diagonal", F.col("at") - F.col("t_at"))
    diagonals = hits.groupBy("k1", "k2", "template", "diagonal").agg(
        F.collect_set("t_at").alias("t_ats"), F.min("at").alias("low"), F.max("at").alias("high")
    )
    order = Window.partitionBy("k1", "k2", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > gap, F.lit(True))
    merged = diagonals.withColumn("apart", apart).withColumn("span", F.sum(F.col("apart").cast("int")).over(order))
    spans = merged.groupBy("k1", "k2", "template", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("t_ats"))).alias("t_ats"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    covered = F.array_distinct(F.flatten(F.transform("t_ats", lambda t: F.sequence(t, t + gram - 1))))
    judged = spans.withColumn("covered", covered).join(F.broadcast(whole), "template").select(
        "k1", "k2", "label", F.col("low").cast("long").alias("first"),
        (F.col("high") - F.col("low") + gram).cast("long").alias("words"),
        (F.size("covered") / F.col("t_len")).alias("share"),
        ((F.size("covered") * 100 >= F.col("t_len") * cover_pct) & (F.size(F.array_except("t_key", "covered")) == 0)).alias("sound"),
    )
    found = judged.groupBy("k1", "k2").agg(
        F.max("share").alias("share"),
        F.sort_array(F.collect_list(F.when(F.col("sound"), F.struct("first", "words", "label", "share")))).alias("spans"),
    )
    base = F.col("row.b")
    labels = F.array_sort(F.array_distinct(F.transform(base, lambda x: x["label"])))
    spans_of = F.coalesce("spans", F.array().cast("array<struct<first:bigint,words:bigint,label:string,share:double>>"))
    joined = marks.filter("at < 0").join(found, ["k1", "k2"], "left")
    return joined.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["start"])).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.transform(spans_of, lambda x: x["label"]))), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size(base) > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"),
        spans_of.alias("spans"),
    )
