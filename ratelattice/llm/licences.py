"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Texts are cut into paragraphs by lines without a word, so hard-wrapped notices stay whole; long
paragraphs are cut into overlapping windows.  A multinomial
logistic regression over hashed words and word pairs gives each paragraph the probabilities
of the licence families and of "unknown".  It is trained on notices composed from fixed
templates, on look-alikes without a licence and on a bounded sample of the corpus's own
paragraphs as "unknown"; the threshold between a family and "unknown" is calibrated on the
part of the notices that training leaves out.  A prediction is confirmed when enough of the word
pairs of one of the family's templates stand in the paragraph; names of one word (MIT) count only
with the words of a notice before them.  Paragraphs that license something under none of the
families are reported as "unknown".

Every text is cut and every window scored: a notice that has lost the word that names its licence
still has the word pairs of its template.

The main path is built-in functions and pyspark.ml.  Null and blank texts have no paragraphs;
repeated rows give repeated findings.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelattice.sources.kept import keep

WINDOW, STEP = 64, 48  # words of a paragraph window, and from one to the next
FEATURES = 1 << 14
SAMPLE_DOCS, SAMPLE_PARAGRAPHS = 2_000, 6_000  # bounds of the corpus sample for "unknown"
CONTEXTS = 300  # paragraphs that notices are put into
CONFIRM = 0.6  # share of a template's word pairs
RELATED = 0.3  # the share below which what licenses something isn't of the family

# Licence families, their names and identifiers
FAMILIES = {
    "apache": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "mit": ("MIT License", "MIT licence", "Expat License", "MIT"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "BSD License", "BSD-3-Clause"),
    "gpl": ("GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL v3", "GNU General Public License", "GPL-3.0-or-later"),
    "lgpl": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License", "GNU LGPL v3", "LGPL-2.1-or-later"),
    "agpl": ("GNU Affero General Public License, version 3", "GNU Affero General Public License", "GNU AGPL v3", "AGPL-3.0-only"),
    "mpl": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"),
    "epl": ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "EPL-2.0"),
    "isc": ("ISC License", "ISC licence", "ISC"),
    "cc0": ("CC0 1.0 Universal", "Creative Commons Zero", "CC0 1.0 Public Domain Dedication", "CC0-1.0"),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"),
    "cc-by-nd": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "CC-BY-ND-4.0"),
    "unlicense": ("The Unlicense", "Unlicense"),
}
# How notices name a licence, and passages that stand for one by themselves
NOTICES = (
    "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under {}.", "This work is licensed under the {}.",
    "Distributed under the terms of the {}.", "This project is made available under the {}, see LICENSE for details.", "SPDX-License-Identifier: {}",
    "License: {}", "The source code is licensed under {}", "This program is free software: you can redistribute it and/or modify it under the terms of the {}.",
    "All content here is published under {} unless noted otherwise.", "Copyright the authors. Use of this source code is governed by the {}.",
)
PASSAGES = {
    "apache": ("you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",),
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "gpl": ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",),
    "lgpl": ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "agpl": ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation",),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use",),
}
UNKNOWN = "unknown"
# Words by which a paragraph licenses something, whatever the licence
LICENSING = (
    r"\bspdx license identifier\b|\blicen[sc]ed under\b|\b(released|distributed|published|available|redistribute|use|used|governed|covered) (it )?(and or modify it )?"
    r"(under|by) (the )?(terms (and conditions )?of (the )?)?(\S+ ){1,8}?licen[sc]e\b"
)
# Sentences that look like a licence notice and name none
LOOKALIKES = (
    "The driver showed a licence at the gate.", "She is a licensed physician in two states.", "All rights reserved.", "Licensed to the highest bidder.",
    "A licence fee is due every year.", "The general public was not admitted to the work.", "This version 2.0 of the report was released in May.",
    "Released under pressure from the public.", "The commons were open to all creative people.", "Version 3 of this work is under review.",
    "Terms and conditions apply to this offer.", "The Apache are a people of the plains.", "The institute at MIT published the source.", "Use of the free software is described in the manual.",
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def paragraphs(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows (``columns``, paragraph, window, words, at, pairs) of the column ``text``; windows only part long paragraphs.

    paragraph is the number of its first line, at the line of each word; pairs are the neighbouring words, joined.
    """
    lines = docs.select(*columns, F.split(F.coalesce("text", F.lit("")), "\n").alias("__lines"))
    lines = lines.withColumn("__words", F.transform("__lines", words_of)).drop("__lines")
    size = lambda i: F.size(F.get(F.col("__words"), i))
    starts = F.filter(F.sequence(F.lit(0), F.size("__words") - 1), lambda i: (size(i) > 0) & ((i == 0) | (size(i - 1) == 0)))
    lines = lines.withColumn("__starts", starts)

    def block(first: Column, k: Column) -> Column:
        part = F.slice("__words", first + 1, F.coalesce(F.get("__starts", k + 1), F.size("__words")) - first)
        return F.struct(first.alias("paragraph"), part.alias("part"))

    def worded(b: Column) -> Column:
        at = F.flatten(F.transform(b["part"], lambda w, j: F.array_repeat(b["paragraph"] + j, F.size(w))))
        return F.struct(b["paragraph"].alias("paragraph"), F.flatten(b["part"]).alias("all"), at.alias("at"))

    def paired(b: Column) -> Column:
        return F.struct(b["paragraph"].alias("paragraph"), b["all"].alias("all"), b["at"].alias("at"), _pairs(b["all"]).alias("pairs"))

    def windows(b: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(b["all"]) - (WINDOW - STEP) - 1, F.lit(0)), F.lit(STEP))
        cut = lambda i, c, n=WINDOW: F.slice(b[c], i + 1, n).alias(c)
        number = lambda i: (i / STEP).cast("int").alias("window")
        return F.transform(starts, lambda i: F.struct(b["paragraph"].alias("paragraph"), number(i), cut(i, "all").alias("words"), cut(i, "at"), cut(i, "pairs", WINDOW - 1)))

    # each step is a lambda's variable, made once; the windows leave one generator whole, as a filter above would move
    # below plain projections and make their columns anew for each word that it looks at
    blocks = F.transform(F.transform(F.transform("__starts", block), worded), paired)
    cut = lines.select(*columns, F.explode(F.flatten(F.transform(blocks, windows))).alias("__w"))
    return cut.select(*columns, *[F.col("__w")[c].alias(c) for c in ("paragraph", "window", "words", "at", "pairs")])


def _pairs(words: Column) -> Column:
    """The neighbouring words, joined."""
    size = F.size(words)
    return F.zip_with(F.slice(words, 1, F.greatest(size - 1, F.lit(0))), F.slice(words, 2, size), lambda a, b: F.concat(a, F.lit(" "), b))


def with_terms(rows: DataFrame) -> DataFrame:
    """Adds ``terms``: the words and word pairs of ``words``, in place of ``pairs`` where ``rows`` has them."""
    pairs = F.col("pairs") if "pairs" in rows.columns else _pairs(F.col("words"))
    return rows.withColumn("terms", F.concat("words", pairs)).drop("pairs")


def notices(spark: SparkSession, contexts: list[list[str]]) -> DataFrame:
    """(family, text) of the fixed notices, passages and look-alikes, alone and among the words of ``contexts``."""
    rows = [(family, form.format(name)) for family, names in FAMILIES.items() for name in names for form in NOTICES]
    rows += [(family, text) for family, texts in PASSAGES.items() for text in texts for _ in range(6)]
    rows += [(UNKNOWN, text) for text in LOOKALIKES for _ in range(6)]
    for i, (family, text) in enumerate(list(rows)):
        if contexts:
            words = contexts[i % len(contexts)][: max(4, WINDOW - len(text.split()) - 8)]
            cut = i * 7 % (len(words) + 1)
            rows.append((family, " ".join([*words[:cut], text, *words[cut:]])))
    return spark.createDataFrame(rows, "family string, text string")


def classes() -> list[str]:
    return [UNKNOWN, *FAMILIES]


def _labelled(rows: DataFrame) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(c) for c in classes()]), F.col("family")) - 1
    return with_terms(rows).withColumn("label", place.cast("double"))


def train(docs: DataFrame) -> tuple[PipelineModel, float]:
    """The model, and the least probability of a family that isn't "unknown"."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null").withColumn("__hash", F.xxhash64("text"))
    # only hashes are ordered; the texts of the lowest ones follow, one of each
    last = texts.select("__hash").distinct().orderBy("__hash").limit(SAMPLE_DOCS).agg(F.max("__hash")).first()[0]
    sample = keep(texts.filter(F.col("__hash") <= F.lit(last)).dropDuplicates(["__hash"]).select("text"), "sample")
    # what names a licence in the corpus is not taken for "unknown"
    names = r"licen[sc]e|copyright|\bcc\b|spdx|redistribut|\bgpl\b|\bmit\b|apache|mozilla|creative commons|public domain"
    plain = paragraphs(sample, "text").filter(~F.array_join("words", " ").rlike(names)).select(F.lit(UNKNOWN).alias("family"), "words")
    plain = keep(plain.orderBy(F.xxhash64("words")).limit(SAMPLE_PARAGRAPHS), "plain")
    contexts = [r["words"] for r in plain.filter("size(words) >= 16").orderBy(F.xxhash64("words")).limit(CONTEXTS).collect()]
    known = keep(notices(spark, contexts).withColumn("doc_id", F.xxhash64("text")), "notices")
    worded = paragraphs(known.withColumnRenamed("doc_id", "id"), "id", "family").filter("window = 0").select("id", "family", "words")
    out = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0
    training = _labelled(worded.filter(~out).select("family", "words").unionByName(plain))
    training = keep(training.select("terms", "label"), "training").coalesce(4)  # bounded rows: many small steps, so few tasks
    stages = [
        HashingTF(inputCol="terms", outputCol="features", numFeatures=FEATURES, binary=True),
        LogisticRegression(maxIter=25, regParam=3e-4, elasticNetParam=0.0, family="multinomial", standardization=False, probabilityCol="probability"),
    ]
    model = Pipeline(stages=stages).fit(training)

    # calibration: the threshold that parts left-out notices from plain paragraphs best
    probe = _labelled(worded.filter(out).select("family", "words").unionByName(plain.limit(1000)))
    scored = _scored(model, probe).select("label", "best", "share")
    steps = [i / 20 for i in range(4, 20)]
    right = [F.avg(((F.when(F.col("share") >= t, F.col("best")).otherwise(0)) == F.col("label")).cast("double")).alias(f"t{i}") for i, t in enumerate(steps)]
    row = scored.groupBy((F.col("label") == 0).alias("plain")).agg(*right).collect()
    gain = [sum(r[f"t{i}"] for r in row) for i in range(len(steps))]
    best = [t for t, g in zip(steps, gain, strict=True) if g >= max(gain) - 1e-9]
    return model, best[len(best) // 2]


def _scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``best``, the likeliest family's number (1 ...), ``share``, its probability, and ``none``, that of "unknown"."""
    hashing, regression = model.stages
    given = regression.copy().setRawPredictionCol("").setPredictionCol("").transform(hashing.transform(rows)).withColumn("__p", vector_to_array("probability"))
    given = given.withColumn("none", F.get("__p", 0)).withColumn("__q", F.slice("__p", 2, len(FAMILIES)))
    return given.withColumns({"share": F.array_max("__q"), "best": F.array_position("__q", F.array_max("__q")).cast("int")}).drop("__p", "__q", "probability", "features")


def template_pairs(spark: SparkSession) -> DataFrame:
    """(family, pairs, whole): the word pairs of each template, a name or a passage.

    A name of one word is a template only with the last words of a notice before it, which must be there as a whole.
    """
    rows = []
    for family, names in FAMILIES.items():
        for text in [*names, *PASSAGES.get(family, ())]:
            if text.isalnum():
                before = {" ".join(form.split("{}")[0].replace("-", " ").split()[-3:]) for form in NOTICES}
                rows += [(family, f"{words} {text}", True) for words in sorted(before)]
            else:
                rows.append((family, text, False))
    worded = spark.createDataFrame(rows, "family string, text string, whole boolean").withColumn("words", words_of(F.col("text"))).filter("size(words) > 1")
    return worded.select("family", F.array_distinct(_pairs(F.col("words"))).alias("pairs"), "whole")


def confirmed_by_templates(found: DataFrame) -> DataFrame:
    """Adds ``template_share``, the largest share of the word pairs of one of the family's templates that ``__w`` has, and ``confirmed``.

    The paragraph of a confirmed row is the line where the template begins.
    """
    templates = template_pairs(found.sparkSession).groupBy("family").agg(F.collect_list(F.struct("pairs", "whole")).alias("__templates"))
    held = found.join(F.broadcast(templates), "family", "left").withColumn("__pairs", _pairs(F.col("__w")))  # one row per family

    def rated(t: Column) -> Column:
        share = F.size(F.array_intersect(t["pairs"], F.col("__pairs"))) / F.size(t["pairs"])
        return F.struct(F.when(~t["whole"] | (share == 1), share).otherwise(0.0).alias("share"), t["pairs"].alias("pairs"))

    shared = held.withColumn("__best", F.array_max(F.transform("__templates", rated)))
    shared = shared.withColumn("template_share", F.coalesce("__best.share", F.lit(0.0))).withColumn("confirmed", F.col("template_share") >= CONFIRM)
    begins = F.array_min(F.filter(F.transform("__pairs", lambda p, i: F.when(F.array_contains(F.col("__best.pairs"), p), F.get("__at", i))), lambda x: x.isNotNull()))
    shared = shared.withColumn("paragraph", F.when(F.col("confirmed"), begins).otherwise(F.col("paragraph")))
    return shared.drop("__templates", "__pairs", "__w", "__at", "__best")


def _licenses(words: Column) -> Column:
    # every alternative has these letters, which are found faster
    return words.contains("licen") & words.rlike(LICENSING)


def scan(docs: DataFrame) -> DataFrame:
    """Per licence paragraph: doc_id, paragraph, window, family, probability, words, template_share, confirmed.

    family is "unknown" for a paragraph that licenses something and that the model gives to no family,
    or to one whose templates it shares next to nothing with; probability is then that of "unknown".
    """
    model, least = train(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    licensing = _licenses(F.array_join("words", " "))
    known = F.col("share") >= least
    scored = _scored(model, with_terms(paragraphs(rows, "doc_id"))).filter(known | licensing)
    family = F.when(known, F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), F.col("best"))).otherwise(UNKNOWN)
    found = scored.select("doc_id", "paragraph", "window", family.alias("family"), F.col("share").alias("probability"), F.array_join("words", " ").alias("words"), F.col("words").alias("__w"), F.col("at").alias("__at"), "none")
    rated = confirmed_by_templates(found)
    unknown = (F.col("family") == UNKNOWN) | ((F.col("template_share") < RELATED) & _licenses(F.col("words")))
    rated = rated.withColumn("__unknown", unknown)
    rated = rated.withColumns({"family": F.when(F.col("__unknown"), UNKNOWN).otherwise(F.col("family")), "probability": F.when(F.col("__unknown"), F.col("none")).otherwise(F.col("probability"))})
    return rated.withColumn("template_share", F.when(F.col("__unknown"), 0.0).otherwise(F.col("template_share"))).drop("none", "__unknown")
