"""Licence scan: a trained paragraph classifier, confirmed against templates.

All of it is built-in functions and the DataFrame side of Spark ML.

1. A sparse logistic regression over word 1- and 2-grams tells licence families from
   ordinary text. Its features are the grams of the templates that are rare in ordinary
   text and hold a rare word; its examples are template sentences, whole and cut, against the
   distinct ordinary paragraphs of all documents. These are counted by the grams of the templates
   that they hold, so the learner reads one weighted row for all that hold the same.
2. Every paragraph (line) of every text is scored: its grams meet the weights by a
   broadcast join of that fixed-size table, so ordinary lines produce next to no rows.
3. A family is named where its probability passes a threshold and enough of the grams of
   one of its template sentences stand in the paragraph. The threshold is calibrated: what ordinary
   paragraphs reach. One half of all, by hash, is learned from, the other calibrated on;
   commonness counts both. A paragraph that passes half the threshold, but not both tests,
   is ``unknown``.

Defined cases: null and empty texts have no paragraph and no licence; equal paragraphs of
a text count each; every document gives one row, repeated rows included; other columns
are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.llm.tables import written

UNKNOWN, ORDINARY = "unknown", ""

#: Opening and characteristic sentences of well-known public licence notices.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU General Public License, version 2 or later.",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU Lesser General Public License",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC0": [
        "Released into the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "Proprietary": [
        "All rights reserved. No part of this work may be reproduced without written permission.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}

#: Least weight of a template example, and how many times as much as all examples the ordinary
#: paragraphs may weigh: beyond it the examples weigh more, so that no corpus drowns them.
EXAMPLE_WEIGHT, ORDINARY_SHARE = 20.0, 3.0
#: Share of distinct ordinary paragraphs from which a gram is no feature.
COMMON = 0.005
#: Share of the rare grams of a template sentence that a confirmed paragraph holds.
#: Words, pairs and (see ``licence_specific``) triples of the templates that make a line no ordinary one.
SPECIFIC = (
    "license", "licensed", "licence", "licenced", "copyright", "copyrighted", "apache", "mit", "bsd", "gnu", "gpl",
    "lgpl", "mozilla", "mpl", "cc0", "noncommercial", "proprietary", "redistribute", "redistribution",
    "rights reserved", "all rights", "creative commons", "public domain", "free software", "hereby granted",
    "written permission", "unauthorized copying", "strictly prohibited", "cc by",
)
CONFIRMED = 0.6
#: Least and greatest calibrated threshold of a probability.
THRESHOLDS = (0.5, 0.95)
REGULARISATION, SPARSENESS = 1e-3, 0.5


def tokens(text: Column) -> Column:
    """Lower-cased letters and digits, in words."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def grams(words: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    pairs = F.transform(F.arrays_zip(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
                                     F.slice(words, 2, 1_000_000_000)),
                        lambda p: F.concat_ws(" ", p["0"], p["1"]))
    return F.array_distinct(F.concat(words, pairs))


def templates(spark: SparkSession) -> DataFrame:
    """(family, template, grams) of the fixed sentences."""
    rows = [(f, k, t) for f, texts in TEMPLATES.items() for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "family string, template int, text string").withColumn(
        "words", tokens(F.col("text"))).withColumn("grams", grams(F.col("words")))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, key, at, words) of every line with words; ``key`` stands for the text."""
    # Words are made ahead of the explode: a filter above it cannot repeat that work.
    lines = docs.select("doc_id", F.xxhash64("text").alias("key"),
                        F.posexplode(F.transform(F.split("text", "\\n"), tokens)).alias("at", "words"))
    return lines.where(F.size("words") > 0)


def with_grams(lines: DataFrame) -> DataFrame:
    return lines.withColumn("grams", grams(F.col("words"))).drop("words")


@dataclass
class Model:
    """``table``: (gram, weights, in_template); the other fields go with its columns."""

    table: DataFrame
    families: list[str]
    words: list[str]
    intercepts: list[float]
    template_family: list[int]
    template_size: list[int]
    threshold: float = 0.0


def held_grams(words: Column, wanted: list[str]) -> Column:
    """The distinct ones of ``wanted`` among all words and runs of two or three neighbours, in order.

    Runs are joined only where a first word of a wanted run stands.
    """
    held = [F.filter(words, lambda w: w.isin([g for g in wanted if " " not in g]))]
    for size in (2, 3):
        runs = [g for g in wanted if g.count(" ") == size - 1]
        firsts = sorted({g.split(" ")[0] for g in runs})
        if runs:
            at = F.transform(words, lambda w, i: F.when(
                w.isin(firsts), F.concat_ws(" ", F.slice(words, i + 1, size))).otherwise(""))
            held.append(F.filter(at, lambda g: g.isin(runs)))
    return F.array_sort(F.array_distinct(F.concat(*held)))


def licence_specific(sentences: list[list[str]]) -> Column:
    """Whether ``words`` hold a specific word or pair, or three neighbouring words of a sentence."""
    runs = sorted({" ".join(w[i : i + 3]) for w in sentences for i in range(len(w) - 2)})
    return F.size(held_grams(F.col("words"), [*SPECIFIC, *runs])) > 0


def ordinary_lines(docs: DataFrame, sentences: list[list[str]], wanted: list[str]) -> DataFrame:
    """(half, grams, lines): how many distinct ordinary paragraphs of all documents hold which of ``wanted``.

    A repeated line counts once and a line with licence wording not at all, so that no
    repetition makes the wording of a notice common. A digest stands for the line, so
    lines are shuffled without their words.
    """
    lines = paragraphs(docs).where(~licence_specific(sentences)).select(
        F.unhex(F.md5(F.concat_ws(" ", "words"))).alias("line"),
        F.pmod(F.xxhash64("words"), F.lit(2)).alias("half"), held_grams(F.col("words"), wanted).alias("grams"))
    return lines.distinct().groupBy("half", "grams").agg(F.count("*").alias("lines"))


def fit(docs: DataFrame) -> Model:
    spark = docs.sparkSession
    known = templates(spark)
    sentences = sorted(known.collect(), key=lambda r: (r["family"], r["template"]))
    families = sorted(TEMPLATES)
    wanted = sorted({g for r in sentences for g in r["grams"]})
    counted = written(ordinary_lines(docs, [r["words"] for r in sentences], wanted))
    n = counted.agg(F.sum("lines")).first()[0] or 0
    common = counted.select(F.explode("grams").alias("gram"), "lines").groupBy("gram").agg(
        F.sum("lines").alias("lines")).where(F.col("lines") > max(1, COMMON * n)).select("gram")
    rare = sorted({*wanted} - {r["gram"] for r in common.collect()})
    words = [g for g in rare if " " not in g]
    rare = [g for g in rare if not set(g.split(" ")).isdisjoint(words)]
    own = [[g for g in r["grams"] if g in set(rare)] for r in sentences]
    ordinary = written(counted.withColumn("grams", F.filter("grams", lambda g: g.isin(rare))).groupBy(
        "half", "grams").agg(F.sum("lines").cast("double").alias("weight")).withColumn("label", F.lit(0.0)))

    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double")
    size = F.size("words")
    middle = F.greatest(F.ceil(size / 2).cast("int"), F.lit(4))
    cuts = F.array("words", F.slice("words", F.lit(1), middle),
                   F.slice("words", F.greatest(size - middle + 1, F.lit(1)), middle))
    learned = ordinary.where("half = 0").select("grams", "label", "weight")
    total = learned.agg(F.sum("weight")).first()[0] or 0.0
    weight = max(EXAMPLE_WEIGHT, total / (ORDINARY_SHARE * len(sentences) * 3))  # three cuts each
    examples = known.select(label.alias("label"), F.explode(cuts).alias("words")).select(
        grams(F.col("words")).alias("grams"), "label", F.lit(weight).alias("weight"))
    vector = CountVectorizerModel.from_vocabulary(rare, inputCol="grams", outputCol="features")
    vector.setBinary(True)
    fitted = LogisticRegression(
        family="multinomial", regParam=REGULARISATION, elasticNetParam=SPARSENESS,
        standardization=False, maxIter=50, weightCol="weight").fit(
        vector.transform(examples.coalesce(1).unionByName(learned)))
    weights = fitted.coefficientMatrix.toArray()
    rows = [(g, [float(w) for w in weights[:, k]], [int(g in o) for o in own])
            for k, g in enumerate(rare)]
    model = Model(
        spark.createDataFrame(rows, "gram string, weights array<double>, in_template array<int>"),
        families, words, [float(b) for b in fitted.interceptVector],
        [families.index(r["family"]) for r in sentences], [max(1, len(o)) for o in own])
    other = ordinary.where("half = 1").select(
        F.monotonically_increasing_id().alias("doc_id"), F.lit(0).alias("key"), F.lit(0).alias("at"), "grams")
    reached = probabilities(other, model).agg(F.max("chance")).first()[0] or 0.0
    low, high = THRESHOLDS
    model.threshold = min(high, max(low, reached))
    return model


def probabilities(lines: DataFrame, model: Model) -> DataFrame:
    """(doc_id, key, at, family, chance, confirmed) of the lines that hold a gram of the model."""
    hits = lines.select("doc_id", "key", "at", F.explode("grams").alias("gram")).join(
        F.broadcast(model.table), "gram")  # a table of fixed size: the grams of the templates
    hits = hits.dropDuplicates(["doc_id", "key", "at", "gram"])  # equal rows are one here
    classes, sentences = range(len(model.intercepts)), range(len(model.template_size))
    sums = hits.groupBy("doc_id", "key", "at").agg(
        *(F.sum(F.get("weights", F.lit(c))).alias(f"w{c}") for c in classes),
        *(F.sum(F.get("in_template", F.lit(t))).alias(f"t{t}") for t in sentences))
    odds = F.array(*(F.exp(F.col(f"w{c}") + model.intercepts[c]) for c in classes))
    total = F.aggregate("odds", F.lit(0.0), lambda a, x: a + x)
    scored = sums.withColumn("odds", odds)
    scored = scored.withColumn("best", F.array_max(F.slice("odds", 2, len(classes))))
    place = F.array_position("odds", F.col("best")) - 1  # 0 is ordinary text
    agree = F.array(*(F.when(F.lit(model.template_family[t] + 1) == F.col("place"),
                             F.col(f"t{t}") / model.template_size[t]).otherwise(0.0) for t in sentences))
    return scored.withColumn("place", place).select(
        "doc_id", "key", "at", F.element_at(F.array(*map(F.lit, [ORDINARY, *model.families])),
                                            (F.col("place") + 1).cast("int")).alias("family"),
        (F.col("best") / total).alias("chance"),
        (F.array_max(agree) >= CONFIRMED).alias("confirmed"))


def licence_paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, key, at, family, chance) of the paragraphs that state a licence."""
    # Every gram of the model holds one of its rare words; other lines hold none.
    lines = paragraphs(docs).where(F.arrays_overlap("words", F.array(*map(F.lit, model.words))))
    scored = probabilities(with_grams(lines), model)
    named = F.when((F.col("chance") >= model.threshold) & F.col("confirmed"), F.col("family"))
    return scored.where(F.col("chance") >= model.threshold / 2).select(
        "doc_id", "key", "at", F.coalesce(named, F.lit(UNKNOWN)).alias("family"), "chance")


def licences(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_licences, n_unknown, families) of every row; families are joined by commas."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    found = licence_paragraphs(docs, model or fit(docs))
    rows = docs.select("doc_id", F.xxhash64("text").alias("key"))
    known = F.col("family") != UNKNOWN
    # Equal rows share what is found of their text.
    shared = found.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.count(F.when(known, 1)).alias("n_licences"), F.count(F.when(~known, 1)).alias("n_unknown"),
        F.concat_ws(",", F.sort_array(F.collect_set(F.when(known, F.col("family"))))).alias("families"))
    out = rows.join(shared, rows["doc_id"].eqNullSafe(shared["d"]) & (rows["key"] == shared["k"]), "left")
    return out.select("doc_id", F.coalesce("n_licences", F.lit(0)).alias("n_licences"),
                      F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"),
                      F.coalesce("families", F.lit("")).alias("families"))
