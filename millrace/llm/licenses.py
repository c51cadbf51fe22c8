"""Licences named in documents, by a trained paragraph classifier.

Paragraphs (lines) with a licensing cue or three words running of a template are described by the word n-grams (1 to 3) they share with
the templates of the licence families; a logistic regression over these sparse counts, trained on
templates, cut templates and paragraphs of other licensing talk, gives family probabilities. The
lowest probability accepted is calibrated on held-out paragraphs without a licence, so that at most
``FALSE_ALARMS`` of them pass; the rest is ``unknown``. A prediction stands only if the paragraph holds
enough of one template of its family. A notice wrapped over several lines is found in a line joined with
the end of those before it, and stands if neither of the two holds it alone.

Paragraphs with a cue are always answered, others if the classifier takes them for a licence. Null and empty
texts have no paragraphs. Everything is DataFrame operations and Spark ML. Ids are answered per
row; repeated rows are answered each.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.shared import prepared, stored

# fixed values: notices as their licences ask for them
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
               "Distributed under the terms of the Apache License 2.0."],
    "bsd": ["Licensed under the BSD 3-Clause License.", "This software is released under the BSD License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 3.",
             "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License."],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
}
UNKNOWN = "unknown"
OTHER = ["All rights reserved, no license is granted.", "The license of this work is not known.", "You need a driving license to rent a car.",
         "Her license was revoked by the board.", "A fishing license costs ten dollars a year.", "Licensed physicians and nurses work here.",
         "Please see the license terms of your vendor.", "The license plate was found near the road.", "Licensed for use by the city council only.",
         "This software is distributed under a commercial license.", "The terms of the agreement are confidential.", "He released a new album this year.",
         "The public library is open at ten.", "Version 3 was released in May.", "Use of this work is permitted for members.",
         "The free version has no license key.", "Creative work under pressure is common.", "The general public is invited.",
         "This work is the result of a long study.", "A license fee is due under the contract.", "Terms and conditions apply, see the license page.",
         "The source of the river is in the hills.", "Under the bridge the water was cold.", "Distributed across the country by rail."]
CUES = r"(?i)licen[cs]|redistribut|permission is hereby granted"
CONFIRMED = 0.75
RUN_LINES = 12
RUN_CHARS = 500
"""Lines and characters before a line that are read with it; the longest template has about 210 characters."""
FALSE_ALARMS = 0.01


def _named() -> str:
    """A pattern of the three-word runs of the templates, by their first words."""
    runs: dict[str, set[str]] = {}
    gap = r"[^\p{L}\p{N}]+"
    for text in (t for family in TEMPLATES.values() for t in family):
        w = re.findall(r"\w+", text.lower())
        for first, *rest in zip(w, w[1:], w[2:]):
            runs.setdefault(first, set()).add(gap.join(rest))
    return r"(?i)\b(?:" + "|".join(f"{first}{gap}(?:{'|'.join(sorted(rest))})" for first, rest in sorted(runs.items())) + r")\b"


NAMED = _named()
"""What holds enough of a template shares three words running with it."""


def words(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def ngrams(tokens: Column, widths: tuple[int, ...] = (1, 2, 3)) -> Column:
    def of(width: int) -> Column:
        last = F.size(tokens) - width + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, width), " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(w) for w in widths]))


def _constant(values: list[str]) -> Column:
    """The values as one folded array."""
    return F.split(F.lit("\n".join(values)), "\n")


def array_known(tokens: Column, vocabulary: list[str]) -> Column:
    """The n-grams of the words that are in the vocabulary."""
    return F.array_intersect(ngrams(tokens), _constant(vocabulary))


class LicenseModel:
    """Vocabulary of template n-grams, the fitted regression, the calibrated threshold."""

    def __init__(self, spark: SparkSession):
        prepared(spark)
        self.names = [*sorted(TEMPLATES), UNKNOWN]
        whole = [(n, t, float(self.names.index(n))) for n in sorted(TEMPLATES) for t in TEMPLATES[n]]
        self.templates = spark.createDataFrame(whole, "family string, text string, label double").select(
            "family", "label", "text", words(F.col("text")).alias("w")).select("*", ngrams(F.col("w")).alias("grams"))
        # constants only: their n-grams are a few hundred
        self.known = [(r["family"], r["grams"]) for r in self.templates.select("family", "grams").collect()]
        self.vocabulary = sorted({g for _, grams in self.known for g in grams})
        self.counts = CountVectorizerModel.from_vocabulary(self.vocabulary, "shared", "features")
        other = spark.createDataFrame([(t, i) for i, t in enumerate(OTHER)], "text string, i int")
        cut = [self._described(self.templates.select("label", F.slice("w", start, F.size("w")).alias("w")).where(F.size("w") > 3)) for start in (1, 2)]
        negative = other.select(F.lit(float(len(self.names) - 1)).alias("label"), words(F.col("text")).alias("w"), "i")
        train = cut[0].unionByName(cut[1]).unionByName(self._described(negative.where("i % 3 <> 0").drop("i")))
        self.regression: LogisticRegressionModel = LogisticRegression(
            family="multinomial", regParam=0.01, elasticNetParam=0.2, maxIter=50).fit(stored(train.coalesce(1)))
        held = self.regression.transform(self._described(negative.where("i % 3 = 0").drop("i")))
        best = F.array_max(F.slice(vector_to_array("probability"), 1, len(self.names) - 1))
        self.threshold = max(0.3, held.agg(F.percentile(best, F.lit(1.0 - FALSE_ALARMS))).first()[0] or 0.0)

    def _described(self, frame: DataFrame) -> DataFrame:
        rest = [c for c in frame.columns if c != "w"]
        return self.counts.transform(frame.select(*rest, array_known(F.col("w"), self.vocabulary).alias("shared")))

    def scan(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, paragraph, family, probability, held, text) of every paragraph with a cue or a likely licence.

        ``held`` is the largest share of a template of the family that the paragraph holds. A notice
        wrapped over lines is answered at the line that completes it.
        """
        lines = F.split(F.col(text_col).cast("string"), r"\n+")
        # a line and the end of the lines before it: whoever wraps a notice, its last line completes it
        ends = F.transform(lines, lambda t: F.right(t, F.lit(RUN_CHARS)))
        runs = F.transform(lines, lambda t, i: F.struct(t.alias("text"), F.right(F.array_join(F.slice(
            ends, F.greatest(i - RUN_LINES + 1, F.lit(1)), F.least(i, F.lit(RUN_LINES))), "\n"), F.lit(RUN_CHARS)).alias("before")))
        found = docs.where(F.col(text_col).rlike(CUES) | F.col(text_col).rlike(NAMED)).select(F.col(id_col).alias("id"), F.posexplode(runs).alias("paragraph", "run")).select(
            "id", "paragraph", "run.text", "run.before", F.concat_ws("\n", "run.before", "run.text").alias("joined")).where(
            F.col("joined").rlike(CUES) | F.col("joined").rlike(NAMED))
        # stored between the steps, so that no step's expressions are repeated within the next
        alone = stored(self._guessed(stored(found), "text", "line"))
        both = stored(self._guessed(alone, "joined", "run"))
        both = stored(both.withColumn("w", words(F.col("before")))).withColumn("known", array_known(F.col("w"), self.vocabulary))
        done = F.greatest(self._held(F.col("run.guess"), F.col("known")), self._held(F.col("run.guess"), F.col("line.shared")))
        run_sure = (F.col("run.probability") >= self.threshold) & (F.col("run.held") >= CONFIRMED) & (done < CONFIRMED)
        line_sure = (F.col("line.probability") >= self.threshold) & (F.col("line.held") >= CONFIRMED)
        named = both.withColumn("line_sure", line_sure).withColumn("run_sure", ~F.col("line_sure") & run_sure)
        best = F.when(F.col("run_sure"), F.col("run")).otherwise(F.col("line"))
        likely = F.col("text").rlike(NAMED) & (F.col("line.probability") >= self.threshold)
        return named.where(F.col("run_sure") | F.col("line_sure") | F.col("text").rlike(CUES) | likely).select(
            "id", "paragraph", F.when(F.col("run_sure") | F.col("line_sure"), best["guess"]).otherwise(UNKNOWN).alias("family"),
            best["probability"].alias("probability"), best["held"].alias("held"), F.when(F.col("run_sure"), F.col("joined")).otherwise(F.col("text")).alias("text"))

    def _held(self, guess: Column, shared: Column) -> Column:
        """The largest share of a template of the guessed family among the n-grams."""
        return F.greatest(F.lit(0.0), *[
            F.when(guess == family, F.size(F.array_intersect(shared, _constant(grams))) / F.lit(float(len(grams))))
            for family, grams in self.known])

    def _guessed(self, frame: DataFrame, text: str, out: str) -> DataFrame:
        """The frame with a struct ``out``: n-grams shared with templates, best family, its probability, share held."""
        kept = frame.columns
        scored = self.regression.transform(self._described(frame.select(*kept, words(F.col(text)).alias("w"))))
        p = F.slice(vector_to_array("probability"), 1, len(self.names) - 1)
        name = F.element_at(F.array(*[F.lit(n) for n in self.names]), F.array_position(p, F.array_max(p)).cast("int"))
        scored = stored(scored.select(*kept, "shared", F.array_max(p).alias("p"), name.alias("guess")))
        return scored.select(*kept, F.struct("shared", F.col("p").alias("probability"), "guess", self._held(F.col("guess"), F.col("shared")).alias("held")).alias(out))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_paragraphs, n_unknown, families) of every document that has a paragraph with a cue or a likely licence."""
    found = LicenseModel(docs.sparkSession).scan(docs, id_col, text_col)
    return found.groupBy("id").agg(F.count("*").alias("n_paragraphs"), F.count_if(F.col("family") == UNKNOWN).alias("n_unknown"),
                                   F.array_join(F.array_sort(F.collect_set(F.when(F.col("family") != UNKNOWN, F.col("family")))), ",").alias("families"))
