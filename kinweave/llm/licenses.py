"""License scans by a trained paragraph classifier.

Paragraphs are classified by a multinomial logistic regression over sparse word n-grams. The
model learns from the families' template sentences and from sentences without a license; a class of its
own stands for the unknown, and a threshold calibrated on paragraphs that the model has not seen guards it.
A prediction counts only if it is confirmed: the paragraph must hold enough of the n-grams of one of
the family's templates. Paragraphs are single lines and, since texts are often wrapped, runs of words over two or more
lines that hold enough of a template; a run counts where none of its lines has its family.

All texts are scored: their n-grams are hashed in one pass and joined with the model's table of
weights (a few thousand rows, fixed by the templates below, hence broadcast); only n-grams that the
model knows are shuffled, and a paragraph without any is unknown by the model's intercepts.

Defined results: null and empty texts have no license; a repeated id gives repeated rows with the
union of what its rows hold; a row with a null id stands for its own text; ties go to the family that comes first; extra columns are not read.
"""

from __future__ import annotations

import json
import math
import random
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import row_key, stored
from kinweave.llm.decontaminate import tokens

#: Sentences by which licenses are named or granted.
TEMPLATES = {
    "AGPL-3.0": ["This program is licensed under the GNU Affero General Public License, version 3.", "GNU Affero General Public License", "Licensed under the GNU AGPL v3", "SPDX-License-Identifier: AGPL-3.0"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "You may not use this file except in compliance with the License.", "Apache License Version 2.0, January 2004", "Released under the Apache 2.0 license", "SPDX-License-Identifier: Apache-2.0"],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD License.", "BSD 3-Clause License",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "Licensed under the BSD 2-Clause license", "Licensed under the BSD 3-Clause license",
        "SPDX-License-Identifier: BSD-2-Clause", "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.", "CC0 1.0 Universal public domain dedication", "SPDX-License-Identifier: CC0-1.0"],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "it under the terms of the GNU General Public License as published by the Free Software Foundation", "GNU General Public License, version 2",
        "Released under the GNU GPL v2 license", "Licensed under the GNU GPL v3", "SPDX-License-Identifier: GPL-2.0", "SPDX-License-Identifier: GPL-3.0",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "GNU Lesser General Public License", "Licensed under the GNU LGPL v3", "SPDX-License-Identifier: LGPL-2.1", "SPDX-License-Identifier: LGPL-3.0"],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0", "Licensed under the MPL 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense", "SPDX-License-Identifier: Unlicense"],
}
#: N-grams that tell versions of a family apart.
VERSIONS = {
    "2": ["version 2", "gpl v2", "gpl 2", "2 clause", "lgpl 2"], "3": ["version 3", "gpl v3", "gpl 3", "agpl v3", "agpl 3", "lgpl v3", "lgpl 3", "3 clause", "neither the name"],
    "4": ["by 4 0", "nc 4 0", "sa 4 0", "attribution 4 0", "noncommercial 4 0", "sharealike 4 0"],
}
UNKNOWN = "unknown"
#: Sentences that speak of licenses, permissions or software but grant nothing.
OTHER = [
    "The driver must carry a valid license at all times.", "The license plate was found in the river.", "Permission to enter the building is given at the desk.", "A copy of the letter was sent to the person in charge.",
    "The software was released in March.", "Version 3 of the report is under review.", "The public library is open to any person.", "This work is part of a larger project.", "The terms of the contract are not public.",
    "She is a general of the public health service.", "The creative commons of the village is free of charge.", "The apache helicopter landed.", "Copyright is a matter of law.", "The foundation gave free meals to the poor.",
    "All rights are explained in the handbook.", "Students of this institute obtained a grant.", "The source of the river is in the hills.", "They are permitted to leave, provided that the doctor agrees.", "Use of the pool is without fee.",
    "He is subject to the terms of his parole.", "The file was lost in compliance checks.", "It is free and easy to use.",
    "The bar is licensed under the number 2034.", "Licensed under the old rules, he kept the boat.", "Released under the bridge, the fish swam off.", "He was released under the terms of the deal.", "Version 2.0 of the plan is ready.", "They met under the general public.",
    "The identifier of the license plate is missing.", "This file is subject to review.", "The Mozilla building is a public place.", "A MIT student found it.", "The clause was part of the second license.", "A lesser general led the public parade.",
]
TRAINING_ROWS, SEED = 5_000, 11
#: n-grams of so many words; a confirmed paragraph holds this share of a template's.
SIZES, CONFIRM = (2, 3), 0.6
#: A license that is broken over lines may hold so many times a template's words; SLOT words are joined at once.
SLACK, SLOT = 1.5, 64


def words(text: str) -> list[str]:
    out, word = [], ""
    for c in text.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def ngrams(text: str) -> list[str]:
    w = words(text)
    return [" ".join(w[i : i + n]) for n in SIZES for i in range(len(w) - n + 1)]


def examples(n: int = TRAINING_ROWS, seed: int = SEED) -> list[dict]:
    """Labelled paragraphs by a fixed recipe: most of a template or of another sentence, between made-up words."""
    r = random.Random(seed)
    families = list(TEMPLATES)
    made = lambda: "".join(r.choice("abcdeghilmnorstu") for _ in range(r.randint(2, 8)))
    rows = []
    for i in range(n):
        label = r.choice(families) if r.random() < 0.6 else UNKNOWN
        w = words(r.choice(TEMPLATES[label])) if label != UNKNOWN else words(r.choice(OTHER)) if r.random() < 0.7 else []
        if label != UNKNOWN and len(w) > 6:
            keep = r.randint(max(5, math.ceil(len(w) * 0.75)), len(w))
            at = r.randint(0, len(w) - keep)
            w = w[at : at + keep]
        if label == UNKNOWN and r.random() < 0.15:  # licenses that are none of the families
            w = words(r.choice(["SPDX-License-Identifier:", "Released under the", "Licensed under the", "This work is licensed under the", "subject to the terms of the"])) + [made() for _ in range(r.randint(1, 2))] + words(r.choice(["", "License", "license 2.0", "agreement"]))
        w = [made() for _ in range(r.choice([0, 0, 3, 12]))] + w + [made() for _ in range(r.choice([0, 0, 3, 12]))]
        if label == UNKNOWN and r.random() < 0.5:  # a few license words out of order
            w += r.sample(words(" ".join(r.choice(TEMPLATES[r.choice(families)]) for _ in range(3))), 4)
        rows.append({"id": i, "label": float([UNKNOWN, *families].index(label)), "grams": ngrams(" ".join(w))})
    return rows


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]  # by n-gram
    least: float  # probability that a prediction needs


def probabilities(model: Model, grams: list[str]) -> list[float]:
    """The classes' probabilities for a paragraph's n-grams; the columnar form below computes the same."""
    z = list(model.intercepts)
    for g in set(grams):
        for k, x in enumerate(model.weights.get(g, ())):
            z[k] += x
    top = max(z)
    e = [math.exp(x - top) for x in z]
    return [x / sum(e) for x in e]


_trained: dict[str, Model] = {}


def train(spark: SparkSession) -> Model:
    """The model, fitted once in a session: its examples don't depend on a corpus."""
    session = spark.sparkContext.applicationId
    if session not in _trained:
        _trained.clear()
        _trained[session] = fitted(spark)
    return _trained[session]


def fitted(spark: SparkSession) -> Model:
    """Fits two thirds of the examples; the threshold is the least at which 99 % of the other third's accepted paragraphs are right."""
    rows = examples()
    schema = "array<struct<id:int,label:double,grams:array<string>>>"
    table = spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema)))
    counted = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0).fit(table)
    fit = LogisticRegression(family="multinomial", maxIter=60, regParam=0.002).fit(counted.transform(table.where("id % 3 != 0")))
    matrix = fit.coefficientMatrix.toArray()
    classes = (UNKNOWN, *TEMPLATES)
    model = Model(classes, tuple(float(x) for x in fit.interceptVector), {g: tuple(float(x) for x in matrix[:, j]) for j, g in enumerate(counted.vocabulary)}, 0.5)
    held = []
    for r in rows:
        if r["id"] % 3 == 0:
            p = probabilities(model, r["grams"])
            k = max(range(len(p)), key=lambda i: (p[i], -i))
            if k:
                held.append((p[k], k == r["label"]))
    least, right = 0.5, 0
    for i, (p, ok) in enumerate(sorted(held, reverse=True), 1):
        right += ok
        if right >= 0.99 * i:
            least = p
    return Model(model.classes, model.intercepts, model.weights, max(0.5, min(least, 0.99)))


def gram_key(array: str, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(F.col(array), at + k) for k in range(n)])


def best_windows(s: Column, longest: Column, size: Column) -> Column:
    """Windows (at, to, first, last) of ordered hits of one template that hold enough of its n-grams; of overlapping ones the fullest.

    A window starts at a hit, is at most ``longest`` words long and ends with the last n-gram that it adds.
    """
    at_once = 2 * math.ceil(SLACK * max(len(words(t)) for ts in TEMPLATES.values() for t in ts))  # two sizes of n-grams begin at a word

    def window(x: Column, k: Column) -> Column:
        near = F.filter(F.slice(s, k + 1, at_once), lambda y: y["to"] <= x["at"] + longest)
        grams = F.transform(near, lambda y: y["g"])
        new = F.filter(near, lambda y, i: F.array_position(grams, y["g"]) == i + 1)
        return F.struct(x["at"].alias("at"), F.array_max(F.transform(new, lambda y: y["to"])).alias("to"), x["a"].alias("first"), F.array_max(F.transform(new, lambda y: y["b"])).alias("last"), (F.size(new) / size).alias("share"))

    full = F.filter(F.transform(s, window), lambda w: w["share"] >= CONFIRM)
    top = lambda acc: F.get(acc, F.size(acc) - 1)
    kept = F.aggregate(
        full,
        F.array().cast("array<struct<at:int,to:int,first:int,last:int,share:double>>"),
        lambda acc, w: F.when((F.size(acc) == 0) | (top(acc)["to"] <= w["at"]), F.concat(acc, F.array(w))).when(w["share"] >= top(acc)["share"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(w))).otherwise(acc),
    )
    return F.filter(kept, lambda w: w["first"] < w["last"])


def scan(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, paragraph (the number, from 0, of its line, or of its first line), family, probability, confirmed share and version (the highest that it names, or null) for every licensed paragraph."""
    spark = df.sparkSession
    templates = [(f, sorted(set(ngrams(t))), len(words(t))) for f, ts in TEMPLATES.items() for t in ts]
    version = {g: v for v, gs in VERSIONS.items() for g in gs}
    known = sorted({*model.weights, *version, *(g for _, gs, _ in templates for g in gs)})
    rows = [{"g": k, "gram": g, "weights": list(model.weights.get(g, [0.0] * len(model.classes))), "of": [i for i, (_, gs, _) in enumerate(templates) if g in gs], "version": version.get(g)} for k, g in enumerate(known)]
    table = spark.range(1, numPartitions=1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<g:int,gram:string,weights:array<double>,of:array<int>,version:string>>")))
    table = table.withColumn("h", tokens(F.col("gram")))
    table = table.withColumn("key", F.coalesce(*[F.when(F.size("h") == n, gram_key("h", F.lit(0), n)) for n in SIZES]))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.transform(F.split(text, "\n", -1), tokens)
    texts = df.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text")).alias("row"), lines.alias("lines"))
    numbers = F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.size(x))))
    texts = texts.select("row", F.flatten("lines").alias("h"), numbers.alias("line")).withColumn("n", F.size("h")).where(F.col("n") >= SIZES[0])
    # n-grams run over line breaks; at and to: the words that one spans, a and b: the lines
    grams = texts.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - SIZES[0])))
    sized = [F.when(F.col("at") + n <= F.col("n"), F.struct(gram_key("h", F.col("at"), n).alias("key"), (F.col("at") + n).alias("to"))) for n in SIZES]
    grams = grams.withColumn("k", F.explode(F.array(*sized))).select("row", "at", F.col("k.to").alias("to"), F.col("k.key").alias("key"), F.get("line", F.col("at")).alias("a"), F.get("line", F.col("k.to") - 1).alias("b"))
    hits = stored(grams.join(F.broadcast(table.select("key", "g")), "key").select("row", "at", "to", "a", "b", "g"))

    weights = table.select("g", "weights", "of", "version")
    sums = [F.sum(F.col("weights")[k]) for k in range(len(model.classes))]
    shares = [F.sum(F.array_contains("of", i).cast("int")) / float(len(g)) for i, (_, g, _) in enumerate(templates)]
    of_family = F.array(*[F.lit(model.classes.index(f)) for f, _, _ in templates])

    def judged(parts: DataFrame, by: list[str]) -> DataFrame:
        """The confirmed families of parts, tables of n-grams."""
        z = parts.select(*by, "g").distinct().join(F.broadcast(weights), "g").groupBy(*by)
        scored = z.agg(F.array(*[s + F.lit(b) for s, b in zip(sums, model.intercepts, strict=True)]).alias("z"), F.array(*shares).alias("share"), F.max("version").alias("version"))
        top = F.array_max("z")
        scored = scored.withColumn("family_at", F.array_position("z", top).cast("int") - 1)
        scored = scored.withColumn("probability", 1 / F.aggregate(F.transform("z", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x))
        best = F.array_max(F.zip_with("share", of_family, lambda s, f: F.when(f == F.col("family_at"), s).otherwise(0.0)))
        scored = scored.withColumn("confirmed", best).where((F.col("family_at") > 0) & (F.col("probability") >= model.least) & (F.col("confirmed") >= CONFIRM))
        return scored.select(*by, "family_at", "probability", "confirmed", "version")

    single = stored(judged(hits.where("a = b"), ["row", "a"]).withColumnRenamed("a", "first"))
    # licenses that are broken over lines: windows of the hits of each template
    each = hits.join(F.broadcast(weights.select("g", F.explode("of").alias("template"))), "g")
    lists = each.groupBy("row", "template").agg(F.sort_array(F.collect_list(F.struct("at", "to", "a", "b", "g"))).alias("s"), F.size(F.collect_set("g")).alias("held"))
    size = F.get(F.array(*[F.lit(float(len(g))) for _, g, _ in templates]), F.col("template"))
    longest = F.get(F.array(*[F.lit(math.ceil(SLACK * n)) for _, _, n in templates]), F.col("template"))
    spans = lists.where(F.col("held") >= CONFIRM * size).select("row", "template", F.explode(best_windows(F.col("s"), longest, size)).alias("w"))
    spans = stored(spans.select("row", F.get(of_family, F.col("template")).alias("wanted"), F.col("w.at").alias("from"), F.col("w.to").alias("until"), "w.first", "w.last").distinct())
    slot = lambda c: F.floor(F.col(c) / SLOT)
    inside = spans.withColumn("slot", F.explode(F.sequence(slot("from"), slot("until")))).join(hits.select("row", "at", "to", "g", slot("at").alias("slot")), ["row", "slot"]).where("at >= from and to <= until")
    runs = judged(inside, ["row", "wanted", "from", "until", "first", "last"]).where("family_at = wanted")
    # of overlapping runs the longest stays, and only where no line of it says the same
    ordered = F.sort_array(F.collect_list(F.struct((F.col("from") - F.col("until")).alias("minus"), "from", "until", "first", "last", "family_at", "probability", "confirmed", "version")))
    runs = runs.groupBy("row").agg(ordered.alias("r"))
    said = single.groupBy("row").agg(F.collect_list(F.struct("first", "family_at")).alias("said"))
    runs = runs.join(said, "row", "left").withColumn("r", F.filter("r", lambda x: ~F.coalesce(F.exists("said", lambda y: (y["family_at"] == x["family_at"]) & y["first"].between(x["first"], x["last"])), F.lit(False))))
    apart = F.aggregate("r", F.slice("r", 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: (y["from"] < x["until"]) & (x["from"] < y["until"])), acc).otherwise(F.concat(acc, F.array(x))))
    runs = runs.select("row", F.inline(apart)).select("row", "first", "family_at", "probability", "confirmed", "version")
    names = F.array(*[F.lit(c) for c in model.classes])
    found = single.unionByName(runs)
    return found.select(F.col("row.id").alias(id_col), F.col("first").cast("long").alias("paragraph"), F.get(names, F.col("family_at")).alias("family"), "probability", "confirmed", "version")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_paragraphs, licenses (distinct families), paragraphs (number:family) and versions (distinct families with the version that their paragraph names), comma-joined, for every row of df."""
    keyed = df.select(id_col, row_key(id_col, text_col).alias("key_"), F.col(text_col).alias("text_"))
    found = scan(keyed, train(df.sparkSession), "key_", "text_")
    lists = found.groupBy("key_").agg(F.sort_array(F.collect_list(F.struct("paragraph", "family", "version"))).alias("all"))
    out = keyed.select(id_col, "key_").join(lists, "key_", "left")
    named = F.filter("all", lambda x: x["version"].isNotNull())
    return out.select(
        id_col,
        F.coalesce(F.when(F.col("all").isNotNull(), F.size("all")), F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.col("all.family"))), ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(F.transform("all", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ","), F.lit("")).alias("paragraphs"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.transform(named, lambda x: F.concat_ws("-", x["family"], x["version"])))), ","), F.lit("")).alias("versions"),
    )
