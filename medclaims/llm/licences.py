"""Operator 9: licence scan by a trained paragraph classifier.

A paragraph is a run of words around a cue word: a line of few words whole, a longer
one in overlapping windows. Each goes to a multinomial logistic regression over hashed
word 1- and 2-grams, trained here on notices of each family (in part, and amid other
words) and, as class ``unknown``, on notices of other licences, on prose with cue words
and on all paragraphs of the corpus that no template resembles. What
counts for a family is its odds against ``unknown`` alone, so that a paragraph can hold several
families. A family is reported if those odds pass a limit calibrated on unknown
paragraphs kept apart, and if the paragraph also holds most words of one of the
family's templates and one of the names (or set phrases) the family goes by. Only
DataFrame functions and Spark's own learner are used; it sums over tasks.

NULL text and texts without cue words give an empty list of families. Very long
lines are windows like any other. Repeated rows are scanned alike; an empty table gives an
empty result; other columns are never looked at.
"""

from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medclaims.llm.common import scratch, scratch_scope

# How notices of common licences read.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "Apache License Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc": [
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY-SA 4.0",
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "This work is licensed under a Creative Commons Attribution-NonCommercial License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved",
        "Copyright, all rights reserved, no part may be reproduced without permission",
        "This software is proprietary and confidential, unauthorized copying is prohibited",
    ],
    "public_domain": [
        "This is free and unencumbered software released into the public domain",
        "To the extent possible under law, all copyright has been waived, CC0 public domain dedication",
        "SPDX-License-Identifier: Unlicense",
    ],
}
# What a paragraph of a family says for certain, as words in a row.
NAMES = {
    "apache": ["apache", "you may not use this file except in compliance with the license"],
    "bsd": ["bsd", "redistribution and use in source and binary forms"],
    "cc": ["creative commons", "cc by"],
    "gpl": ["gnu general public", "gpl"],
    "lgpl": ["gnu lesser general public", "lgpl"],
    "mit": ["mit", "to any person obtaining a copy of this software"],
    "mpl": ["mozilla public", "mpl"],
    "proprietary": ["all rights reserved", "proprietary and confidential"],
    "public_domain": ["released into the public domain", "public domain dedication", "unlicense"],
}
# Notices of other licences and prose with cue words, which teach `unknown`.
OTHERS = [
    "Released under the ISC License",
    "Licensed under the ISC License",
    "This software is released under the zlib License",
    "Licensed under the European Union Public License 1.2",
    "Licensed under the European Union Public Licence, version 1.2 or later",
    "Distributed under the Boost Software License, Version 1.0",
    "Released under the Artistic License 2.0",
    "Licensed under the Eclipse Public License 2.0",
    "Licensed under the EPL 2.0",
    "Released under the Common Development and Distribution License, Version 1.0",
    "Licensed under the SIL Open Font License, Version 1.1",
    "Licensed under the Academic Free License version 3.0",
    "Released under the PostgreSQL License",
    "This work is licensed under the Open Database License",
    "Released under the Python Software Foundation License Version 2",
    "Do what you want to public license",
    "SPDX-License-Identifier: ISC",
    "SPDX-License-Identifier: Zlib",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: BSL-1.0",
    "a driving license is a permission to drive a car",
    "she lost her license and asked for permission to leave",
    "the state issues a license to sell food in public places",
    "poetic license gave the author permission to change the story",
    "the law of copyright protects authors of books",
    "a public domain of the city where people meet",
    "the redistribution of wealth was a question of the day",
    "the company has proprietary methods of its own",
    "without the permission of the owner nobody may enter",
    "the new license plate was issued under the old law",
]
UNKNOWN = "unknown"
CLASSES = [UNKNOWN, *TEMPLATES]
# every template has one of these
CUES = r"(?i)licen[cs]e|copyright|rights reserved|public domain|redistribution|permission|proprietary"

# a line of so many words is one paragraph; windows of a longer one reach so far to both sides of a cue
LINE_WORDS = 40
REACH = 20
FEATURES = 1 << 12
LEAST_PROBABILITY = 0.5
# share of the unknown paragraphs kept apart that may pass the limit
FALSE_ALARMS = 0.001
LEAST_SIMILARITY = 0.75
# steps of probability that the limit is told by
_BINS = 1000


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def grams_of(words: Column) -> Column:
    """Each word and each pair of neighbours once."""
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.array_distinct(F.concat(words, pairs))


def featured(paragraphs: DataFrame) -> DataFrame:
    """Adds grams and the sparse vector to rows with ``words``."""
    rows = paragraphs.withColumn("grams", grams_of(F.col("words")))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(rows)


# windows of (cue, word number) lists: from REACH words before a cue to as many after it; a cue that
# the window before has at its middle or earlier needs no window of its own
_WINDOWS = f"""CASE WHEN size(words) <= {LINE_WORDS} THEN array(words) ELSE transform(
    aggregate(filter(sequence(0, size(words) - 1), i -> words[i] RLIKE '{{cues}}'), CAST(array() AS array<int>),
              (kept, i) -> CASE WHEN size(kept) > 0 AND i - kept[size(kept) - 1] < {REACH // 2} THEN kept ELSE concat(kept, array(i)) END),
    i -> slice(words, greatest(i - {REACH}, 0) + 1, 2 * {REACH} + 1)) END"""
_CUE_WORDS = "licen[cs]e|copyright|rights|reserved|public|domain|redistribution|permission|proprietary"


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraphs): the words of the paragraphs around cue words."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(CUES))
    words = F.transform(lines, words_of)
    windows = F.expr("flatten(transform(lines, words -> " + _WINDOWS.replace("{cues}", _CUE_WORDS) + "))")
    empty = F.array().cast("array<array<string>>")
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.when(F.col("text").rlike(CUES), words).otherwise(empty).alias("lines"),
    ).select("row", "doc_id", windows.alias("paragraphs"))


def unknown_paragraphs(found: DataFrame) -> DataFrame:
    """The distinct paragraphs of the corpus that no template resembles; half of them calibrate."""
    rows = found.select(F.explode("paragraphs").alias("words")).distinct()
    best = F.greatest(*[template_share(F.col("words"), family) for family in TEMPLATES])
    return rows.where(best < LEAST_SIMILARITY).select(
        F.lit(0.0).alias("label"), "words", F.pmod(F.xxhash64("words"), F.lit(2)).alias("part")
    )


def notices(spark) -> DataFrame:
    """The templates whole, without their first or last words, and amid other words."""
    rows = []
    for number, (family, templates) in enumerate(TEMPLATES.items(), 1):
        for template in templates:
            words = template.split()
            keep = max(2, len(words) - 2)
            for text in (template, " ".join(words[:keep]), " ".join(words[-keep:]), f"{template} see the file for details",
                         f"Note: {template}, by the authors 2024"):
                rows += [(float(number), text)] * 5
    for text in OTHERS:
        words = text.split()
        rows += [(0.0, t) for t in (text, f"{text}.", f"Note: {text}, by the authors 2024", f"{text} see the file for details",
                                    " ".join(words[:-1]), " ".join(words[1:]))] * 5
    labels, texts = zip(*rows)
    given = spark.createDataFrame(pa.table({"label": pa.array(labels), "text": pa.array(texts)}))
    return given.select("label", words_of(F.col("text")).alias("words"), F.lit(0).cast("long").alias("part"))


def other_notices(spark) -> DataFrame:
    """Notices of other licences as they read in a longer line, for calibration."""
    texts = [f"{before} {text} {after}" for text in OTHERS for before, after in (("The module is", "as stated"), ("See:", ""), ("", "2024, all files"))]
    given = spark.createDataFrame(pa.table({"text": pa.array(texts)}))
    return given.select(F.lit(0.0).alias("label"), words_of(F.col("text")).alias("words"), F.lit(1).cast("long").alias("part"))


def train(found: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """The classifier and the probability against ``unknown`` that a family must pass."""
    spark = found.sparkSession
    rows = notices(spark).unionByName(other_notices(spark)).unionByName(unknown_paragraphs(found))
    with scratch_scope(spark):
        rows = scratch(rows, "teaching")
        learner = LogisticRegression(maxIter=60, regParam=0.001, family="multinomial", aggregationDepth=2)
        model = learner.fit(featured(rows.where("part = 0")).select("label", "features"))
        apart = with_odds(model, rows.where("part = 1")).select(F.array_max("chances").alias("chance"))
        bins = {r.bin: r["count"] for r in apart.groupBy(F.ceil(F.col("chance") * _BINS).cast("int").alias("bin")).count().collect()}
    above, limit = 0, _BINS
    for bin_ in sorted(bins, reverse=True):
        limit = bin_
        above += bins[bin_]
        if above > FALSE_ALARMS * sum(bins.values()):
            break
    # an unknown notice that is as sure as can be leaves the decision to the names
    return model, min(max(LEAST_PROBABILITY, limit / _BINS), 0.9)


def with_odds(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """Adds ``chances``: the probability of each family, as if it and ``unknown`` were all there is."""
    rows = model.transform(featured(rows)).withColumn("raw", vector_to_array("rawPrediction"))
    odds = F.transform(F.slice("raw", 2, len(TEMPLATES)), lambda x: 1 / (1 + F.exp(F.get("raw", F.lit(0)) - x)))
    return rows.withColumn("chances", odds).drop("probability", "prediction", "rawPrediction", "features", "grams", "raw")


def template_share(words: Column, family: str) -> Column:
    """The share of a template's words that the paragraph holds, at the family's best template."""
    def share(template: str) -> Column:
        own = sorted(set("".join(c if c.isalnum() else " " for c in template.lower()).split()))
        return F.size(F.array_intersect(words, F.array(*map(F.lit, own)))) / len(own)

    return F.greatest(F.lit(0.0), *map(share, TEMPLATES[family]))


def named(words: Column, family: str) -> Column:
    """Whether the paragraph has one of the names of the family, word by word."""
    text = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(f" {name} ")) for name in NAMES[family]])


def families_of(rows: DataFrame, limit: float) -> DataFrame:
    """(row, family, probability, similarity): all families that pass in a paragraph with ``words`` and ``chances``."""
    tested = [
        F.struct(F.lit(family).alias("family"), F.get("chances", F.lit(i)).alias("probability"),
                 F.when(named(F.col("words"), family), template_share(F.col("words"), family)).alias("similarity"))
        for i, family in enumerate(TEMPLATES)
    ]
    found = rows.select("row", "number", F.inline(F.array(*tested)))
    return found.where((F.col("similarity") >= LEAST_SIMILARITY) & (F.col("probability") >= limit))


def scan(docs: DataFrame) -> DataFrame:
    """Per document the licence families found, and the surest paragraph's figures."""
    found = scratch(paragraphs(docs), "paragraphs")
    model, limit = train(found)
    rows = found.select("row", F.posexplode("paragraphs").alias("number", "words"))
    by_doc = families_of(with_odds(model, rows), limit).groupBy("row").agg(
        F.count_distinct("number").alias("n_paragraphs"), F.sort_array(F.collect_set("family")).alias("families"),
        F.max("probability").alias("probability"), F.max("similarity").alias("similarity"),
    )
    return found.select("row", "doc_id").join(by_doc, "row", "left").select(
        "doc_id", F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"), "probability", "similarity",
    )
