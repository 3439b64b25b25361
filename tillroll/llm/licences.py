"""Licence statements in documents: an n-gram classifier of paragraphs, confirmed by templates. Built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tillroll.llm.common import materialise

# Usual statements of each licence family.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "Distributed under the terms of the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc_by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution International License."],
    "cc_by_nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution NonCommercial License."],
    "cc_by_sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution ShareAlike License."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License.",
        "Licensed under the GPL.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": ["Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "public_domain": ["This work is in the public domain.", "To the extent possible under law, the author has waived all copyright to this work."],
    "reserved": ["All rights reserved.", "Copyright by the author. All rights reserved."],
}
FAMILIES = sorted(TEMPLATES)
NONE = float(len(FAMILIES))
_WINDOW, _STEP = 64, 40
# Words that ordinary text may have too, but few statements lack: a piece with one is no example of ordinary text.
_TELLING = sorted({
    *("licence", "licences", "licenced", "license", "licenses", "licensed", "licensee", "licensing", "copyright", "copyrighted", "copyleft", "spdx"),
    *("redistribute", "redistributed", "redistribution", "permission", "permissions", "permitted", "reserved", "warranty"),
})
_LEAST_ANY = 0.02  # a piece is a licence statement with this probability at least
# What comment blocks put before and after the text of a line.
_MARKS = r"(?m)^[ \t]*(?:<!--+|/\*+!?|//+!?|\*+/?|#+|;+|--+|%+|>+|\"{3}|'{3})?[ \t]*|[ \t]*(?:\*+/|--+>|[*#]+)?[ \t]*$"


def pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, piece, text): sentences of each document's paragraphs; numbered from 0, those without letters left out.

    Paragraphs end at blank lines, also at lines of a comment's mark alone; the lines of a paragraph are one text, so a
    statement may be wrapped anywhere. A sentence ends at a mark and white space before a capital letter.
    """
    text = F.regexp_replace(F.regexp_replace(F.col("text").cast("string"), r"\r\n?", "\n"), _MARKS, "")
    parts = F.split(text, r"\n{2,}|(?<=[.!?])\s+(?=\p{Lu})")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(parts).alias("piece", "text"))
    return rows.filter(F.col("text").rlike(r"\p{L}"))


def _windows(rows: DataFrame) -> DataFrame:
    """Words of `text` in windows of at most `_WINDOW`, with `word`, the first word's place.

    Windows of a long piece overlap, so that a statement is whole in one of them and little else is with it.
    """
    words = rows.withColumn("words", F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")).drop("text")
    beyond = F.greatest(F.ceil((F.size("words") - _WINDOW) / _STEP), F.lit(0)).cast("int") * _STEP
    cut = words.withColumn("word", F.explode(F.sequence(F.lit(0), beyond, F.lit(_STEP))))
    return cut.withColumn("words", F.slice("words", F.col("word") + 1, F.lit(_WINDOW)))


def _featured(windows: DataFrame) -> DataFrame:
    """Adds `grams`, words and word pairs, and `features`, which words and pairs of the templates are among them."""
    paired = NGram(n=2, inputCol="words", outputCol="pairs").transform(windows)
    both = paired.withColumn("grams", F.concat("words", "pairs")).drop("words", "pairs")
    vocabulary = sorted({g for texts in TEMPLATES.values() for t in texts for g in _grams(t)})
    seen = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0)
    return seen.setBinary(True).transform(both)


def _templates(spark: SparkSession) -> DataFrame:
    """(family, text) as a table of literals."""
    rows = [F.struct(F.lit(float(FAMILIES.index(f))).alias("label"), F.lit(t).alias("text")) for f in FAMILIES for t in TEMPLATES[f]]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _grams(text: str) -> list[str]:
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return list(dict.fromkeys([*words, *map(" ".join, zip(words, words[1:], strict=False))]))


def likeness(grams: Column, family: str) -> Column:
    """The largest share of a template of the family that the text has, in words and word pairs."""
    shares = [F.size(F.array_intersect(grams, F.array(*map(F.lit, _grams(t))))) / len(_grams(t)) for t in TEMPLATES[family]]
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def _any_likeness(grams: Column) -> Column:
    return F.greatest(*[likeness(grams, f) for f in FAMILIES])


def _chances() -> tuple[Column, Column]:
    """Probabilities of the families, and of any of them."""
    chances = F.slice(vector_to_array("probability"), 1, len(FAMILIES))
    return chances, F.aggregate(chances, F.lit(0.0), lambda a, b: a + b)


def _plain(words: Column, grams: Column) -> Column:
    """Whether a window counts as ordinary text: unlike every template, and without a word that statements turn on."""
    return (_any_likeness(grams) < 0.5) & ~F.arrays_overlap(words, F.array(*map(F.lit, _TELLING)))


def fit(docs: DataFrame, sample_docs: int = 400, sample_pieces: int = 6000) -> LogisticRegressionModel:
    """The classifier.

    Families are learned from their templates, ordinary text from at most `sample_pieces` different windows of
    `sample_docs` documents that a hash picks from the whole table; windows like a template or with a telling word, which may be
    statements of a licence without template, are left out. Ordinary text has four times the weight of all templates.
    """
    spark = docs.sparkSession
    some = docs.select("doc_id", "text").orderBy(F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", "text").limit(sample_docs)
    windows = _windows(pieces(some)).select("words").distinct().orderBy(F.xxhash64("words"), "words").limit(sample_pieces)
    windows = materialise(windows, "windows").withColumn("own", F.col("words"))
    plain = _featured(windows.repartition(8)).filter(_plain(F.col("own"), F.col("grams")))
    ordinary = materialise(plain.select("features"), "ordinary")
    weight = 4.0 * sum(map(len, TEMPLATES.values())) / max(1, ordinary.count())
    known = _featured(_windows(_templates(spark))).select("features", "label", F.lit(1.0).alias("weight"))
    rows = known.unionByName(ordinary.select("features", F.lit(NONE).alias("label"), F.lit(weight).alias("weight")))
    rows = materialise(rows.coalesce(1), "lessons")
    classes = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-4, maxIter=60).fit(rows)
    # One expression per row instead of a chain of three.
    classes.setRawPredictionCol("").setPredictionCol("")
    return classes


def _limit(scored: DataFrame, below: int, quantile: float = 0.999) -> float:
    """The probability that a piece has to pass.

    One in a thousand windows of ordinary text is above it, of all in the table: the `below` that have less than `_LEAST_ANY`
    and those in `scored`. It never exceeds one half, so what is more likely a statement than not always comes out,
    however common it is.
    """
    usual = scored.filter("plain")
    above = usual.count()
    rank = quantile * (below + above) - below
    if rank <= 0:
        return _LEAST_ANY
    return min(0.5, usual.agg(F.percentile_approx("any", rank / above, 100_000)).first()[0])


def scan(docs: DataFrame, least_likeness: float = 0.6, **options) -> DataFrame:
    """(doc_id, piece, word, family, probability, likeness) for each piece of text that reads like a licence statement.

    A piece counts as one where the probability of all families together is above that of ordinary text (see `_limit`).
    `family` is the most probable where it is more likely than not and a template of the family has at least
    `least_likeness` of its words and pairs in the piece; else it is "unknown".

    Null or empty text has no pieces. Null ids and repeated rows are scanned each. Other columns are ignored; an
    empty table gives no rows.
    """
    classes = fit(docs, **options)
    chances, any_licence = _chances()
    windows = _windows(pieces(docs)).withColumn("own", F.col("words"))
    scored = classes.transform(_featured(windows)).select("doc_id", "piece", "word", "own", "grams", chances.alias("chances"), any_licence.alias("any"))
    low = Observation()
    scored = scored.observe(low, F.count(F.when(F.col("any") <= _LEAST_ANY, 1)).alias("n")).filter(F.col("any") > _LEAST_ANY)
    guess = F.element_at(F.array(*map(F.lit, FAMILIES)), F.array_position("chances", F.array_max("chances")).cast("int"))
    rows = scored.select("doc_id", "piece", "word", "own", "grams", "any", guess.alias("guess"), F.array_max("chances").alias("probability"))
    alike = reduce(lambda so_far, f: so_far.when(F.col("guess") == f, likeness(F.col("grams"), f)), FAMILIES, F)
    rows = rows.withColumns({"likeness": alike, "plain": _plain(F.col("own"), F.col("grams"))}).drop("own", "grams")
    rows = materialise(rows, "scored")
    rows = rows.filter(F.col("any") > _limit(rows, low.get["n"]))
    family = F.when((F.col("probability") > 0.5) & (F.col("likeness") >= least_likeness), F.col("guess")).otherwise("unknown")
    return rows.select("doc_id", F.col("piece").cast("int").alias("piece"), "word", family.alias("family"), "probability", "likeness")
