"""Licence notices in documents, with built-in functions and MLlib only.

Every line of a text is classified, and so is every run of neighbouring lines that share words with the templates, which
is where a wrapped notice lies (an empty line ends a run): the words and word pairs that occur in licence templates are
the sparse features, a multinomial logistic regression gives the probability of each licence family and of "unknown",
and an isotonic regression on rows that were not trained on calibrates the probability that there is a licence at all.
A prediction is confirmed by comparison with the templates: enough three-word shingles of a template of that family
have to be there, those that hold its version or variant all of them, no template of another family may fit better,
and the verb of the notice may not be denied.

The regression learns from windows of the templates and from a bounded number of lines of the corpus, which are
"unknown" unless a template is in them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perennia.sources.scratch import stored

# Notices by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "Apache-1.1": ["Licensed under the Apache Software License, Version 1.1."],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0 Universal.",
        "The author has dedicated the work to the public domain under CC0 1.0 Universal.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "All rights reserved": ["All rights reserved."],
}
# Licences that come in versions, their names and the numbers of their versions.
GNU = {"GPL": "General", "LGPL": "Lesser General", "AGPL": "Affero General"}
GNU_VERSIONS = {"GPL": ["2.0", "3.0"], "LGPL": ["2.1", "3.0"], "AGPL": ["1.0", "3.0"]}
COMMONS = {"CC-BY": "Attribution", "CC-BY-SA": "Attribution-ShareAlike", "CC-BY-NC": "Attribution-NonCommercial"}
COMMONS |= {"CC-BY-ND": "Attribution-NoDerivatives", "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike"}
for _key, _name in GNU.items():
    for _version in GNU_VERSIONS[_key]:
        TEMPLATES[f"{_key}-{_version}"] = [
            f"{_what} is licensed under the GNU {_name} Public License, version {_version}."
            for _what in ("This work", "This library", "This program")
        ] + [
            f"Licensed under the GNU {_name} Public License v{_version}.",
            f"you can redistribute it and/or modify it under the terms of the GNU {_name} Public License as published"
            f" by the Free Software Foundation, either version {_version} of the License, or any later version",
        ]
for _version in ("1.1", "2.0"):
    TEMPLATES[f"MPL-{_version}"] = [
        f"This Source Code Form is subject to the terms of the Mozilla Public License, v. {_version}."
    ]
for _key, _name in COMMONS.items():
    for _version, _where in (("3.0", "Unported"), ("4.0", "International")):
        TEMPLATES[f"{_key}-{_version}"] = [
            f"Licensed under {_key.replace('-', ' ', 1)} {_version}.",
            f"This work is licensed under a Creative Commons {_name} {_version} {_where} License.",
        ]
# Sentences that speak of licences and grant none.
OTHER = [
    "You need a driving license to rent a car.",
    "The license plate was lost in the public car park.",
    "The terms of the agreement are under review by the public.",
    "A new version of the software was released under pressure.",
    "Apache helicopters and the Mozilla office are in the news.",
    "She studied at MIT and works under a general manager.",
    "All the rights of the person are reserved for the court to decide.",
    "Permission to use the room is granted by the office free of charge.",
]

# Words that tell variants of a licence apart, words that deny, and what they deny.
VARIANTS = "lesser affero clause sharealike noncommercial noderivatives sa nc nd cc0 isc mit apache mozilla bsd".split()
DENIED = (
    r" (not|never|cannot|no longer|isn t|wasn t|aren t)( \w+){0,2}"
    r" (licensed|released|granted|dedicated|redistribute|permitted|subject|reserved|obtain|all rights) "
)

UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]
#: Expected number of paragraphs of the corpus that are learned from.
TRAINING_PARAGRAPHS = 20_000
#: Least calibrated probability of a licence, least share of a template's shingles that confirms it.
LIKELY, CONFIRMING = 0.5, 0.6
SHINGLE = 3


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; a number keeps its dots, but for a final ``.0``."""
    whole = F.regexp_replace(F.lower(text), r"(?<=\p{N})\.0(?![\p{L}\p{N}]|\.\p{N})", "")
    return F.filter(F.split(whole, r"[^\p{L}\p{N}.]+|\.(?!\p{N})|(?<!\p{N})\."), lambda w: w != "")


def shingles(tokens: Column) -> Column:
    """Distinct runs of three words; of fewer words, one of all."""
    n = F.size(tokens)
    starts = F.sequence(F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda k: F.array_join(F.slice(tokens, k, SHINGLE), " ")))


def paragraphs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row (of the document), paragraph (a line, from 0, empty lines counted) and words of every line that has some."""
    rows = docs.select(F.col(id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    return lines.select("doc_id", "row", "paragraph", words(F.col("line")).alias("words")).filter(F.size("words") > 0)


def runs(lines: DataFrame) -> DataFrame:
    """Neighbouring lines of a document as one: doc_id, row, paragraph (the first), lines and words; two lines or more."""
    order = F.row_number().over(Window.partitionBy("row").orderBy("paragraph"))
    members = F.array_sort(F.collect_list(F.struct("paragraph", "words")))
    grouped = lines.withColumn("run", F.col("paragraph") - order).groupBy("row", "run")
    joined = grouped.agg(F.first("doc_id").alias("doc_id"), F.count("*").cast("int").alias("lines"), members.alias("m"))
    joined = joined.filter("lines > 1").select("doc_id", "row", F.col("m")[0]["paragraph"].alias("paragraph"), "lines", "m")
    return joined.select("doc_id", "row", "paragraph", "lines", F.flatten(F.transform("m", lambda x: x["words"])).alias("words"))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts] + [(UNKNOWN, t) for t in OTHER]
    values = ", ".join(f"('{family}', '{text}')" for family, text in rows)
    table = spark.sql(f"select * from values {values} as t(family, text)")
    return table.select("family", words(F.col("text")).alias("words"))


def _known(spark: SparkSession) -> list[tuple[str, list[str], list[str]]]:
    """Family, shingles and decisive shingles of each template: those with a number or a variant in them."""
    rows = _templates(spark).filter(F.col("family") != UNKNOWN).select("family", shingles(F.col("words")).alias("s")).collect()
    decides = re.compile(r"\b(\w*\d\S*|" + "|".join(VARIANTS) + r")(?!\S)")
    return [(r["family"], r["s"], [x for x in r["s"] if decides.search(x)]) for r in rows]


def fit_of_templates(spark: SparkSession, own: str) -> Column:
    """For each template: share and number of its shingles that are in the column ``own``, its family, and whether all
    that decide are there."""
    return F.array(
        *[
            F.struct(
                (F.size(F.array_intersect(_literals(s), F.col(own))) / len(s)).alias("share"),
                F.lit(len(s)).alias("size"),
                F.lit(family).alias("family"),
                (F.size(F.array_intersect(_literals(d), F.col(own))) == len(d) if d else F.lit(True)).alias("decided"),
            )
            for family, s, d in _known(spark)
        ]
    )


def _shared(spark: SparkSession) -> Column:
    """Whether a line may be a part of a wrapped notice: it has a shingle of a template, or is a word or two of theirs."""
    own = sorted({x for _, s, _ in _known(spark) for x in s})
    each = _literals(sorted({w for x in own for w in x.split()}))
    short = (F.size("words") < SHINGLE) & F.forall("words", lambda w: F.array_contains(each, w))
    return short | F.arrays_overlap(shingles(F.col("words")), _literals(own))


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in values])


@dataclass
class LicenseModel:
    features: PipelineModel
    calibration: IsotonicRegressionModel


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", rows: int = TRAINING_PARAGRAPHS) -> LicenseModel:
    """A classifier for paragraphs; documents are chosen by a hash of their ids so that about ``rows`` paragraphs come."""
    spark = docs.sparkSession
    templates = _templates(spark)
    n = F.size("words")
    # windows of a template that hold at least two thirds of it, as often as there are places for them
    sizes = F.sequence(F.ceil(n * 2 / 3).cast("int"), n)
    windows = templates.select("family", "words", F.explode(sizes).alias("size"))
    windows = windows.select("family", "words", "size", F.explode(F.sequence(F.lit(1), n - F.col("size") + 1)).alias("at"))
    windows = windows.select("family", F.slice("words", F.col("at"), F.col("size")).alias("words"))
    size = docs.agg(F.count("*").alias("n"), F.sum(F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))).alias("lines")).first()
    share = min(1.0, rows / max(1, size["lines"] or 1))
    some = docs.filter(F.pmod(F.xxhash64(id), F.lit(1 << 30)) < int(share * (1 << 30)))
    best = F.array_max(F.filter(fit_of_templates(spark, "own"), lambda t: t["decided"]))
    # written, so that the comparison is computed once; a bounded number of rows
    seen = stored(paragraphs(some, id, text).select("words", shingles(F.col("words")).alias("own")))
    seen = stored(seen.select("words", best.alias("best")))
    seen = seen.select(F.when(F.col("best.share") >= CONFIRMING, F.col("best.family")).otherwise(UNKNOWN).alias("family"), "words")
    seen = seen.filter((F.col("family") == UNKNOWN) | (F.size("words") < 60))
    all_ = windows.unionByName(seen)
    number = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family")) - 1
    weight = F.when(F.col("family") == UNKNOWN, 1.0).otherwise(5.0)
    labelled = all_.select("words", number.cast("double").alias("label"), weight.alias("weight"), F.pmod(F.xxhash64("words"), F.lit(4)).alias("part"))
    labelled = stored(labelled)
    vocabulary = templates.filter(F.col("family") != UNKNOWN)
    single = CountVectorizer(inputCol="words", outputCol="singles", binary=True).fit(vocabulary)
    pair = NGram(n=2, inputCol="words", outputCol="pairs_of_words")
    double = CountVectorizer(inputCol="pairs_of_words", outputCol="doubles", binary=True).fit(pair.transform(vocabulary))
    together = VectorAssembler(inputCols=["singles", "doubles"], outputCol="features")
    regression = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=30, weightCol="weight")
    stages = Pipeline(stages=[single, pair, double, together, regression])
    features = stages.fit(labelled.filter("part <> 0"))
    unseen = features.transform(labelled.filter("part = 0"))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="is", weightCol="weight")
    known = unseen.select((1 - vector_to_array("probability")[0]).alias("raw"), (F.col("label") > 0).cast("double").alias("is"), "weight")
    ends = spark.sql("select * from values (0.0d, 0.0d, 1.0d), (1.0d, 1.0d, 1.0d) as t(raw, is, weight)")
    return LicenseModel(features, isotonic.fit(known.unionByName(ends)))


def _classified(lines: DataFrame, model: LicenseModel) -> DataFrame:
    """``lines`` with the calibrated probability of a licence and its family."""
    own = lines.columns
    each = vector_to_array("probability")
    scored = model.features.transform(lines).select(*own, each.alias("each"), (1 - each[0]).alias("raw"))
    scored = model.calibration.setPredictionCol("calibrated").setFeaturesCol("raw").transform(scored)
    kinds = F.slice("each", 2, len(FAMILIES))
    best = F.array_position(kinds, F.array_max(kinds)).cast("int")
    return scored.select(*own, "calibrated", F.element_at(_literals(list(TEMPLATES)), best).alias("family"))


def find(docs: DataFrame, model: LicenseModel, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each line, or run of lines, that holds a licence notice.

    doc_id, paragraph (its first line), lines, family (the classifier's), probability (calibrated, of any licence),
    similarity (share of the best template of that family) and confirmed.  A run is a row only if it is confirmed and
    none of its lines alone is confirmed as that family.  Texts that are null or hold no words give no rows; repeated
    rows give theirs as often.  Runs two jobs over the documents' lines.
    """
    spark = docs.sparkSession
    shared = _shared(spark)
    likely = F.col("calibrated") >= LIKELY
    kept = stored(_classified(paragraphs(docs, id, text), model).filter(likely | shared))
    wrapped = _classified(runs(kept.filter(shared).select("doc_id", "row", "paragraph", "words")), model)
    alone = kept.filter(likely).withColumn("lines", F.lit(1))
    found = stored(alone.unionByName(wrapped.filter(likely)).withColumn("own", shingles(F.col("words"))))
    found = found.withColumn("fits", fit_of_templates(spark, "own"))
    of_family = F.filter("fits", lambda t: t["family"] == F.col("family"))
    decided = F.filter("fits", lambda t: t["decided"])
    best = F.array_max(decided)
    denied = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).rlike(DENIED)
    confirmed = F.coalesce((best["family"] == F.col("family")) & (best["share"] >= CONFIRMING) & ~denied, F.lit(False))
    similarity = F.array_max(F.transform(of_family, lambda t: t["share"]))
    found = stored(
        found.select(
            "doc_id",
            "row",
            "paragraph",
            "lines",
            "family",
            F.col("calibrated").alias("probability"),
            similarity.alias("similarity"),
            confirmed.alias("confirmed"),
        )
    )
    single = found.filter("lines = 1")
    known = single.filter("confirmed").select("row", "family", F.col("paragraph").alias("line"))
    several = found.filter("lines > 1 and confirmed")
    within = (F.col("line") >= F.col("paragraph")) & (F.col("line") < F.col("paragraph") + F.col("lines"))
    several = several.alias("a").join(
        known.alias("b"), (F.col("a.row") == F.col("b.row")) & (F.col("a.family") == F.col("b.family")) & within, "left_anti"
    )
    return single.unionByName(several).drop("row")
