"""License scans: paragraphs that state a licence, by family.

Method: a trained paragraph classifier.  A paragraph is a line, scored in
windows of ``WINDOW`` words that begin every ``STEP`` words and cover the whole
line.  A window's word 1- and 2-grams, hashed into sparse vectors, go through
multinomial logistic regression over the licence families and an unknown class;
probabilities are calibrated by a temperature chosen on held-out labelled
windows.  A family of at least ``CHECK_P`` in some window of a line is checked,
also where unknown is likelier: it is confirmed when the line's windows of that
family together hold at least ``CONFIRM`` of the word 3-grams of one of its
templates, and else reported as unconfirmed from ``LEAST_P`` on.  A line can state several families; one goes if
another holds more of its template and they share 3-grams, or it holds none.

Training rows are windows of the templates with seeded variations (words left
out, prose around), and for the unknown class written counter-examples and a bounded
sample of corpus lines (of about ``TRAIN_DOCS`` documents, picked by a hash)
without a licence word.  Scoring runs over every line of every document, with
DataFrame functions and Spark ML's DataFrame estimators only.

Results for odd input: null, empty and blank texts have no licence.  Repeated
rows each get the result of their (doc_id, text); a null doc_id stays null.
An empty table gives an empty table.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.session import written

#: Sentences of public licence notices by family.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "all-rights-reserved": ["All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": ["Released under the BSD License.", "Use of this source code is governed by a BSD-style license.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "mit": [
        "Released under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "public-domain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived "
                      "all copyright and related rights to this work.", "Licensed under CC0 1.0 Universal."],
}
UNKNOWN = "unknown"
COUNTER = [
    "The driver was licensed to drive heavy vehicles.", "She renewed her fishing license in the spring.", "The film was released under a new title.",
    "Version 2.0 of the software adds dark mode.", "The public was free to use the park.", "Work on the general plan began in version 3 of the draft.",
    "The table was reserved for all guests.", "Human rights were reserved to the assembly.", "MIT opened a new laboratory.", "Apache helicopters flew over the city.",
    "Terms of the agreement were not met.", "The foundation published a report on free software.", "They license their patents to other firms.",
    "It is distributed in most countries.", "A creative project that everyone in common enjoyed.", "Permission was granted to the visitors.",
    "Source and binary forms were compared.", "Copyright law changed last year.", "The commercial was shown without warranty.", "Read the conditions before use.",
]
CUES = r"(?i)licen[cs]|copyright|reserved|spdx|warrant|creative commons|public domain|permission|redistribut|\bcc\b"
FEATURES, LEAST_P, CHECK_P, CONFIRM = 1 << 12, 0.5, 0.01, 0.7
VARIATIONS, TRAIN_DOCS, SEED = 24, 300, 11
#: Words of a window and between the beginnings of windows: a notice of up to
#: WINDOW - STEP + 1 words is whole in some window, a longer one has that many of each of its ends in one.
WINDOW, STEP = 32, 16


def words(line: str) -> Column:
    """Lower-case words of letters, digits and inner marks."""
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def grams(w: str) -> Column:
    """Word 1- and 2-grams of an array of words."""
    return F.expr(f"concat({w}, zip_with(slice({w}, 1, greatest(size({w}) - 1, 0)), slice({w}, 2, greatest(size({w}) - 1, 0)), (a, b) -> concat(a, ' ', b)))")


def shingles(w: str) -> Column:
    """Distinct word 3-grams; fewer words are one."""
    return F.expr(f"array_distinct(transform(sequence(1, greatest(size({w}) - 2, 1)), i -> concat_ws(' ', slice({w}, i, 3))))")


def windows(w: str) -> Column:
    """Overlapping windows of an array of words, to its end."""
    return F.expr(f"transform(sequence(0, cast((greatest(size({w}) - {WINDOW}, 0) + {STEP - 1}) div {STEP} as int)), i -> slice({w}, i * {STEP} + 1, {WINDOW}))")


def labelled() -> list[tuple[str, str]]:
    """(family, paragraph): templates and counter-examples with their variations."""
    rnd, rows = random.Random(SEED), []
    filler = "the of to and in on with for this that was is by from it as at be or an".split()
    syllables = "an er on the re ti es en at ed nd ha st ou le la de que ung sch ment tion".split()

    def prose(n: int) -> str:
        return " ".join(rnd.choice(filler) if rnd.random() < 0.3 else "".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(n))

    for family, texts in [*TEMPLATES.items(), (UNKNOWN, COUNTER)]:
        for text in texts:
            rows.append((family, text))
            for _ in range(VARIATIONS if family != UNKNOWN else VARIATIONS // 4):
                keep = [w for w in text.split() if len(text.split()) < 8 or rnd.random() > 0.08]
                rows.append((family, " ".join(filter(None, [prose(rnd.randint(0, 9)), " ".join(keep), prose(rnd.randint(0, 9))]))))
                # a window somewhere in a long paragraph, with as much of the notice as some window has
                n = min(len(keep), WINDOW - STEP + 1)
                at = WINDOW + rnd.randint(n - WINDOW, len(keep) - n)
                rows.append((family, " ".join([*prose(WINDOW).split(), *keep, *prose(WINDOW).split()][at: at + WINDOW])))
    rows += [(UNKNOWN, prose(rnd.randint(1, 60))) for _ in range(20 * VARIATIONS)]
    return rows


def _vectors(rows: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(rows.withColumn("grams", grams("w")))


def fit(docs: DataFrame) -> tuple[list[str], LogisticRegressionModel, float]:
    """Families, the fitted model, and the temperature of its calibration."""
    spark = docs.sparkSession
    names = [UNKNOWN, *sorted(TEMPLATES)]
    share = min(1.0, TRAIN_DOCS / max(1, docs.count()))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))
    lines = picked.select(F.explode(F.split("text", "\n")).alias("line")).where(~F.col("line").rlike(CUES) & (F.length("line") > 0))
    known = _local(spark, [(float(names.index(f)), t) for f, t in labelled()], {"label": pa.float64(), "line": pa.string()})
    rows = known.union(lines.select(F.lit(0.0).alias("label"), "line")).withColumn("w", words("line")).where("size(w) > 0")
    rows = rows.select("label", F.explode(windows("w")).alias("w"))
    rows = _vectors(rows).withColumn("held", F.pmod(F.xxhash64("w"), F.lit(5)) == 0).select("label", "features", "held")
    rows = written(rows, "paragraphs")
    model = LogisticRegression(family="multinomial", regParam=2e-4, maxIter=60).fit(rows.where("not held"))
    held = model.transform(rows.where("held")).select("label", vector_to_array("rawPrediction").alias("raw")).collect()
    raw, y = np.array([r.raw for r in held]), np.array([int(r.label) for r in held])

    def loss(t: float) -> float:
        z = raw / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]))

    return names, model, min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0), key=loss) if len(y) else 1.0


def _local(spark: SparkSession, rows: list[tuple], fields: dict[str, pa.DataType]) -> DataFrame:
    """A fixed table from Arrow columns: it lies in the plan, so no task starts a Python worker for it."""
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(zip(*rows), fields.values())], list(fields)))


def templates(spark: SparkSession) -> DataFrame:
    """family, number and 3-grams of each template."""
    rows = _local(spark, [(f, i, t) for f, texts in TEMPLATES.items() for i, t in enumerate(texts)], {"family": pa.string(), "number": pa.int32(), "line": pa.string()})
    return rows.withColumn("w", words("line")).select("family", "number", shingles("w").alias("template"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line (number), family, p and confirmed of the families stated in each line."""
    names, model, heat = fit(docs)
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line", "said"))
    rows = lines.withColumn("w", words("said")).where("size(w) > 0").select("doc_id", "text_key", "line", F.explode(windows("w")).alias("w"))
    # behind a generator, so that no filter on the scores is pushed down and computes them again
    raw = model.transform(_vectors(rows).drop("grams")).select("doc_id", "text_key", "line", "w", F.explode(F.array(vector_to_array("rawPrediction"))).alias("raw"))
    raw = raw.where(F.expr(f"array_max(slice(raw, 2, {len(names)})) >= array_max(raw) + {heat * math.log(CHECK_P)}D"))
    raw = raw.withColumn("top", F.array_max("raw")).withColumn("e", F.expr(f"transform(raw, x -> exp((x - top) / {heat}D))"))
    raw = raw.withColumn("sum", F.expr("aggregate(e, double(0), (s, x) -> s + x)"))
    found = (raw.select("doc_id", "text_key", "line", "sum", shingles("w").alias("own"), F.posexplode("e").alias("at", "e"))
             .where(F.expr(f"at > 0 and e >= {CHECK_P} * sum"))
             .select("doc_id", "text_key", "line", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("at") + 1).alias("family"), (F.col("e") / F.col("sum")).alias("p"), "own"))
    hits = found.join(templates(docs.sparkSession), "family").withColumn("hit", F.array_intersect("own", "template"))
    by_template = (hits.groupBy("doc_id", "text_key", "line", "family", "number")
                   .agg(F.max("p").alias("p"), F.max(F.size("template")).alias("size"), F.array_distinct(F.flatten(F.collect_set("hit"))).alias("hit")))
    by_family = by_template.withColumn("share", F.size("hit") / F.col("size")).groupBy("doc_id", "text_key", "line", "family").agg(
        F.max("p").alias("p"), F.max(F.struct("share", "hit")).alias("best"))
    by_line = by_family.where((F.col("p") >= LEAST_P) | (F.col("best.share") >= CONFIRM)).groupBy("doc_id", "text_key", "line").agg(F.collect_list(F.struct("family", "p", "best.share", "best.hit")).alias("all"))
    stated = F.expr("filter(all, x -> not exists(all, y -> y.share > x.share and (size(x.hit) = 0 or arrays_overlap(x.hit, y.hit))))")
    return (by_line.select("doc_id", "text_key", "line", F.explode(stated).alias("x"))
            .select("doc_id", "text_key", "line", "x.family", "x.p", (F.col("x.share") >= CONFIRM).alias("confirmed")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_licences, families (sorted, comma-joined), lines of the confirmed paragraphs, and n_unconfirmed of every row."""
    found = paragraphs(docs).groupBy("doc_id", "text_key").agg(
        F.count_if("confirmed").alias("n"), F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("line")))).alias("lines"), F.count_if(~F.col("confirmed")).alias("open"))
    found = found.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
            .select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_licences"), F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
                    F.coalesce("lines", F.array().cast("array<int>")).alias("lines"), F.coalesce("open", F.lit(0)).cast("long").alias("n_unconfirmed")))
