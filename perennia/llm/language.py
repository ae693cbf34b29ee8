"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the text under a character-trigram model of each language,
the language that the markup declares, the last label of the address, and the languages seen on the same host.  How
far declarations and suffixes can be trusted is counted, not assumed: the text alone gives each document a posterior,
and sums of these posteriors by declared language, suffix and host give the likelihoods and the priors.  A host's
prior is smoothed towards that of its domain, the domain's towards its suffix, and that towards the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import batch, begin, temporary
from perennia.sources.scratch import stored

#: Hash buckets of trigrams, and pseudo counts of each.
BUCKETS, PSEUDO = 1 << 16, 0.05
#: Expected number of labelled rows from which the text model is learned, and most languages it knows.
TRAINING_ROWS, LANGUAGES = 20_000, 200
#: A text counts for at most so many independent trigrams: neighbours are far from independent.
INDEPENDENT = 40
#: Rows by which a host, domain or suffix is drawn towards the level above.
STRENGTH = 20.0
#: Least posterior of a document that is kept.
CERTAIN = 0.6

def trigrams(text: str | None) -> np.ndarray:
    """Bucket of each trigram of a whole text: letters in lower case, all else one blank."""
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letters = (points >= 97) & ((points <= 122) | (points >= 170)) & (points != 215) & (points != 247)
    points = np.where(letters, points, 32).astype(np.uint64)
    blank = points == 32
    points = np.concatenate(([32], points[~(blank & np.concatenate(([True], blank[:-1])))], [32])).astype(np.uint64)
    if len(points) < 3:
        return np.empty(0, np.int64)
    mixed = (points[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (points[2:] * np.uint64(0x165667B19E3779F9))) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(48)).astype(np.int64)


def text_of_markup(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments, tags and character references become blanks."""
    gone = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
    return F.regexp_replace(html, gone, " ")


def declared_in_markup(html: Column) -> Column:
    """The primary tag of the first lang attribute; null without one."""
    tag = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})\b", 1))
    return F.when(tag != "", tag)


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


@dataclass
class LanguageModel:
    """Languages, log probabilities of trigram buckets, and the counted evidence tables."""

    languages: list[str]
    logs: np.ndarray  # languages, buckets
    corpus: np.ndarray  # prior of each language
    declared: DataFrame | None = None  # declared, log likelihood ratios
    hosts: DataFrame | None = None  # host, log prior


def learn_text(docs: DataFrame, text: Column, language: Column, id: Column, rows: int = TRAINING_ROWS) -> LanguageModel:
    """Trigram counts of labelled rows, summed by group.

    Languages are counted over all rows.  Of larger inputs, rows are chosen by a hash of their ids at a rate for each
    language: all rows of rare languages and equal expected numbers of the others, so that about ``rows`` are expected.
    """
    known = docs.select(text.alias("text"), F.lower(language).alias("language"), id.alias("id")).filter("language is not null and text is not null")
    found = known.groupBy("language").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "language").limit(LANGUAGES).collect()
    rates = sampling_rates({r["language"]: r["n"] for r in found}, rows)
    if any(rate < 1 for rate in rates.values()) or len(rates) == LANGUAGES:
        bounds = F.create_map([F.lit(x) for k, rate in rates.items() for x in (k, int(rate * (1 << 30)))])
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < bounds[F.col("language")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for t, language in zip(b[0].to_pylist(), b[1].to_pylist(), strict=True):
                total = sums.setdefault(language, np.zeros(BUCKETS, np.int64))
                total += np.bincount(trigrams(t), minlength=BUCKETS)
        for language, total in sums.items():
            used = np.flatnonzero(total)
            yield batch({"language": pa.array([language] * len(used)), "bucket": pa.array(used), "n": pa.array(total[used])})

    partial = known.select("text", "language").mapInArrow(counted, "language string, bucket long, n long")
    table = stored(partial.groupBy("language", "bucket").agg(F.sum("n").alias("n")))
    languages = sorted(r["language"] for r in table.select("language").distinct().collect())  # LANGUAGES at most
    counts = np.zeros((len(languages), BUCKETS))
    number = {x: k for k, x in enumerate(languages)}
    for r in table.toLocalIterator():  # LANGUAGES * BUCKETS rows at most
        counts[number[r["language"]], r["bucket"]] = r["n"]
    used = max(1, int((counts.sum(axis=0) > 0).sum())) if languages else 1
    logs = np.log(counts + PSEUDO) - np.log(counts.sum(axis=1, keepdims=True) + PSEUDO * max(used, 1000))
    n = len(languages)
    return LanguageModel(languages, logs.astype(np.float32), np.full(n, 1 / n) if n else np.empty(0))


def sampling_rates(sizes: dict[str, int], rows: int) -> dict[str, float]:
    """For each language the share of its rows to take: the same expected number of all that have so many."""
    left, each = rows, 0.0
    for done, n in enumerate(sorted(sizes.values())):
        each = left / (len(sizes) - done)
        if n > each:
            break
        left -= n
        each = float(n)
    return {language: min(1.0, each / n) for language, n in sizes.items()}


def likelihood_column(text: Column, model: LanguageModel) -> Column:
    """Tempered log likelihood of each language, as array<double>; null for a text without letters."""
    logs = model.logs.T.copy()  # one row of all languages for a bucket

    @F.arrow_udf("array<double>")
    def likelihoods(texts: pa.Array) -> pa.Array:
        begin("language")
        out = []
        for t in texts.to_pylist():
            found = trigrams(t)
            out.append(logs[found].mean(axis=0).astype(float) * min(len(found), INDEPENDENT) if len(found) else None)
        return pa.array(out, pa.list_(pa.float64()))

    return likelihoods.asNondeterministic()(text)


def _weights(logs: Column) -> Column:
    """Log weights as weights, the largest of them 1."""
    return F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))


def _total(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)


def learn_evidence(evidence: DataFrame, model: LanguageModel) -> LanguageModel:
    """Counts over all rows of ``evidence`` (likelihoods, declared, host): priors and likelihood tables.

    A model that knows no language stays as it is.
    """
    n = len(model.languages)
    if not n:
        return model
    table = evidence.filter("likelihoods is not null")
    weights = table.select("declared", "host", _weights(F.col("likelihoods")).alias("w"))
    weights = weights.select("declared", "host", "w", _total(F.col("w")).alias("t"))
    soft = weights.select("declared", "host", *[(F.col("w")[k] / F.col("t")).alias(f"p{k}") for k in range(n)])
    total = [F.sum(f"p{k}").alias(f"p{k}") for k in range(n)]
    hosts = stored(soft.groupBy("host").agg(*total))  # a row for each host
    whole = hosts.agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(n)]).first()
    seen = np.array([whole[k] or 0.0 for k in range(n)])
    corpus = (seen + 1) / (seen.sum() + n)
    # the languages' shares of each declared value, against their shares in the corpus
    stated = soft.filter("declared is not null").groupBy("declared").agg(*total)
    rows = sum((F.col(f"p{k}") for k in range(1, n)), F.col("p0"))
    ratio = [F.log((F.col(f"p{k}") + STRENGTH * float(corpus[k])) / (rows + STRENGTH) / float(corpus[k])) for k in range(n)]
    declared = stored(stated.select("declared", F.array(*ratio).alias("stated")))
    named = hosts.filter("host is not null")
    named = named.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))
    named = named.withColumn("domain", F.when(F.col("domain") == "", F.col("host")).otherwise(F.col("domain")))

    def smoothed(counts: DataFrame, above: str | None) -> Column:
        up = [F.col(above)[k] if above else F.lit(float(corpus[k])) for k in range(n)]
        return F.array(*[(F.col(f"p{k}") + STRENGTH * up[k]) / (rows + STRENGTH) for k in range(n)])

    suffixes = named.groupBy("suffix").agg(*total)
    suffixes = suffixes.select("suffix", smoothed(suffixes, None).alias("of_suffix"))
    domains = named.groupBy("domain", "suffix").agg(*total).join(suffixes, "suffix")
    domains = domains.select("domain", "suffix", smoothed(domains, "of_suffix").alias("of_domain"))
    priors = named.join(domains, ["domain", "suffix"]).select("host", smoothed(named, "of_domain").alias("prior"))
    priors = stored(priors.select("host", F.transform("prior", lambda p: F.log(p)).alias("prior")))
    return LanguageModel(model.languages, model.logs, corpus, declared, priors)


def fuse(df: DataFrame, model: LanguageModel, likelihoods: str, declared: Column, host: Column) -> DataFrame:
    """``df`` with language and confidence from its likelihoods, declaration and host.

    Where a kind of evidence is missing it says nothing; without any text evidence the rest decides, and without
    any evidence, or with a model that knows no language, the language is null with confidence 0.
    """
    if not model.languages:
        return df.withColumns({"language": F.lit(None).cast("string"), "confidence": F.lit(0.0)})
    a, b = temporary("declared"), temporary("host")
    stated, prior = temporary("stated"), temporary("prior")
    df = df.withColumn(a, F.lower(declared)).withColumn(b, host)
    df = df.join(model.declared.withColumnsRenamed({"declared": a, "stated": stated}), a, "left")
    df = df.join(model.hosts.withColumnsRenamed({"host": b, "prior": prior}), b, "left")
    silent = F.array(*[F.lit(0.0)] * len(model.languages))
    usual = F.array(*[F.lit(float(x)) for x in np.log(model.corpus)])
    nothing = F.col(likelihoods).isNull() & F.col(stated).isNull() & F.col(prior).isNull()
    logs = F.zip_with(F.coalesce(likelihoods, silent), F.coalesce(stated, silent), lambda x, y: x + y)
    logs = F.zip_with(logs, F.coalesce(prior, usual), lambda x, y: x + y)
    fused, none = temporary("fused"), temporary("none")
    df = df.withColumns({fused: logs, none: nothing})
    logs, nothing = F.col(fused), F.col(none)
    names = F.array(*[F.lit(x) for x in model.languages])
    kept = [c for c in df.columns if c not in (a, b, stated, prior, fused, none, "language", "confidence")]
    return df.select(
        *[F.col(f"`{c}`") for c in kept],
        F.when(~nothing, F.element_at(names, F.array_position(logs, F.array_max(logs)).cast("int"))).alias("language"),
        F.when(nothing, 0.0).otherwise(1 / _total(_weights(logs))).alias("confidence"),
    )


def evidence(df: DataFrame, model: LanguageModel, text: Column, declared: Column, host: Column, *keep: str) -> DataFrame:
    """likelihoods, declared and host of each row, and the columns ``keep``; written once."""
    columns = [likelihood_column(text, model).alias("likelihoods"), F.lower(declared).alias("declared"), host.alias("host")]
    return stored(df.select(*[F.col(c) for c in keep], *columns))


def identify(df: DataFrame, model: LanguageModel, text: Column, declared: Column, host: Column) -> DataFrame:
    """All rows and columns of ``df`` with language and confidence (columns of these names are replaced).

    Repeated rows stay.  With a model that knows no language, language is null and confidence 0.
    """
    if not model.languages:
        return df.withColumns({"language": F.lit(None).cast("string"), "confidence": F.lit(0.0)})
    name = temporary("likelihoods")
    return fuse(df.withColumn(name, likelihood_column(text, model)), model, name, declared, host).drop(name)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def is_kept(letters: Column, confidence: Column, least: float = CERTAIN) -> Column:
    """Whether a document stays: it has letters, and its language is certain enough."""
    return letters & (confidence >= least)
