"""Toxicity by weak supervision.

Voters are simple tests of a whole text: does it hold a word of this part of a lexicon, does it shout, does it call
somebody names.  The lexicon is a fixed seed and the words and word beginnings that tell toxic from other labelled
documents; a family of near copies counts once for a word.  How often each combination of votes occurs is counted over all documents; there are at
most ``2 ** VOTERS`` combinations, so the counts are small whatever the input.  From them a generative label model
estimates each voter's accuracy for either class and the correlations of voters (a tree of the strongest ones), with the
labelled rows as anchors.  Its posterior labels train a linear classifier on counts of what the voters saw.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import begin, temporary
from perennia.sources.scratch import stored

# Words that insult in the languages of the corpus.
SEED = """
idiot moron stupid worthless pathetic trash scum loser clown disgusting imbecile bastard retard whore slut
idiote imbécile connard salope crétin ordure dégueulasse abruti
arschloch dummkopf trottel abschaum wichser schlampe vollidiot widerlich
idiota imbécil estúpido gilipollas basura cabrón asqueroso escoria
""".split()
# Words that address the reader.
ADDRESS = frozenset("you your yours u ur tu toi vous votre ton du dich dir ihr sie euch tú usted vosotros eres".split())

#: Lexicon voters and pattern voters; every combination of their votes has a number below 2 ** VOTERS.
LEXICON_VOTERS, PATTERN_VOTERS = 8, 4
VOTERS = LEXICON_VOTERS + PATTERN_VOTERS
#: Most labelled rows from which lexicon words are learned, and most words learned.
LABELLED_ROWS, LEARNED_WORDS = 20_000, 2000
#: Least share of toxic documents with a word, least factor by which it is more frequent there, least G statistic.
SUPPORT, LIFT, SURE = 0.02, 8.0, 30.0
#: Minhashes of a text's runs of RUN words, and how many of them near copies have in common at least.
HASHES, ALIKE, RUN = 32, 16, 3
#: What a family of near copies weighs; its rows have equal, whole parts of it, so that sums do not depend on their order.
WHOLE = 1 << 30
#: Lengths of the word beginnings that are tried; in the lexicon they end in "*".
BEGINNINGS = range(4, 9)

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def voter_of(word: str, lexicon: dict[str, int]) -> int:
    """The voter of a word, by itself or by its beginning; -1 for none."""
    voter = lexicon.get(word)
    if voter is None:
        for n in BEGINNINGS:
            if n > len(word):
                break
            voter = lexicon.get(word[:n] + "*")
            if voter is not None:
                return voter
        return -1
    return voter


def features_of(text: str | None, lexicon: dict[str, int]) -> list[float]:
    """Votes (0 or 1 each), then logarithms of counts, of a whole text."""
    if not text:
        return [0.0] * (2 * VOTERS + 1)
    words = words_of(text)
    voters = {w: v for w in set(words) if (v := voter_of(w, lexicon)) >= 0}
    found = [(k, voters[w]) for k, w in enumerate(words) if w in voters] if voters else []
    hits = np.bincount([v for _, v in found], minlength=LEXICON_VOTERS) if found else np.zeros(LEXICON_VOTERS)
    addressed = sum(not ADDRESS.isdisjoint(words[max(0, k - 4) : k + 5]) for k, _ in found)
    distinct = len(voters)
    share = 100 * len(found) / max(1, len(words))
    marks = text.count("!!") + text.count("!?")
    votes = [*(hits > 0).astype(float), float(addressed > 0), float(distinct > 1), float(share >= 1), float(marks > 2)]
    amounts = [*np.log1p(hits), np.log1p(addressed), np.log1p(distinct), np.log1p(share), np.log1p(marks)]
    return votes + amounts + [float(bool(found))]


def learn_lexicon(docs: DataFrame, labels: DataFrame) -> dict[str, int]:
    """The voter of each lexicon word, from seed words and labelled rows of ``docs`` (id, text; id, y).

    At most ``LABELLED_ROWS`` labels are used, in the order of a hash of their ids.  All their rows count; the rows of
    a family of near copies weigh one row together.
    """
    sample = labels.orderBy(F.xxhash64("id"), "id").limit(LABELLED_ROWS)
    known = docs.join(F.broadcast(sample), "id").select("text", "y")  # the limit bounds what is sent

    @F.arrow_udf("struct<signature:array<int>,words:array<string>>")
    def distinct(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            own = words_of(text or "")
            words = sorted(set(own))
            starts = {w[:n] + "*" for w in words for n in BEGINNINGS if n <= len(w)}
            out.append({"signature": signature_of(own), "words": words + sorted(starts)})
        return pa.array(out, pa.struct([("signature", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))]))

    rows = known.select("y", distinct.asNondeterministic()("text").alias("d")).select("y", "d.*")
    rows = stored(rows.withColumn("copy", F.xxhash64("signature")))
    weights = _family_weights(rows)
    rows = rows.join(F.broadcast(weights), ["y", "copy"]).select("y", "words", "weight")
    totals = {r["y"]: r["n"] / WHOLE for r in rows.groupBy("y").agg(F.sum("weight").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    learned = []
    if toxic and clean:
        counts = rows.select("y", "weight", F.explode("words").alias("word")).groupBy("word").agg(
            (F.sum(F.col("weight") * F.col("y")) / WHOLE).alias("toxic"),
            (F.sum(F.col("weight") * (1 - F.col("y"))) / WHOLE).alias("clean"),
        )
        lift = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / (clean + 0.5))
        expected = (F.col("toxic") + F.col("clean")) * (toxic / (toxic + clean))
        sure = 2 * F.col("toxic") * F.log(F.col("toxic") / expected)
        strong = counts.filter((F.col("toxic") >= SUPPORT * toxic) & (lift >= LIFT) & (sure >= SURE))
        weight = F.col("toxic") * F.log(lift)
        learned = strong.orderBy(F.desc(weight), F.col("word").endswith("*"), "word").limit(LEARNED_WORDS).collect()
    most = max((r["toxic"] for r in learned), default=0)
    kept: list[str] = []
    beginnings: list[str] = []  # the kept ones that end in "*"
    common: list[str] = []
    for r in learned:
        stem, is_beginning = r["word"].removesuffix("*"), r["word"].endswith("*")
        if stem in kept or any(stem.startswith(k) for k in beginnings):
            continue  # a kept beginning matches it
        if is_beginning and any(k.startswith(stem) for k in kept):
            continue  # one of a word and its beginnings is enough
        kept.append(stem)
        if is_beginning:
            beginnings.append(stem)
        if r["toxic"] >= most / 8:
            common.append(r["word"])
    # common words are dealt over the first voters; one voter has the rarer words, one the seed words not met
    voters = {word: LEXICON_VOTERS - 1 for word in SEED}
    voters |= {r["word"]: LEXICON_VOTERS - 2 for r in learned if r["word"].removesuffix("*") in kept}
    return voters | {word: k % (LEXICON_VOTERS - 2) for k, word in enumerate(common)}


def signature_of(words: list[str]) -> np.ndarray:
    """Minhashes of the runs of ``RUN`` words of a text; of fewer words, of one run of all."""
    import xxhash

    own = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    each = np.array([own[w] for w in words] or [0], np.uint64)
    each = np.concatenate([each, np.zeros(max(0, RUN - len(each)), np.uint64)])
    runs = np.zeros(len(each) - RUN + 1, np.uint64)
    for k in range(RUN):
        runs = (runs ^ each[k : k + len(runs)]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(29)
    runs = np.unique(runs)
    least = np.empty(HASHES, np.int32)
    for k in range(HASHES):
        mixed = (runs ^ np.uint64((k + 1) * 0x165667B19E3779F9 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        least[k] = (mixed >> np.uint64(33)).min()
    return least


def families_of(signatures: np.ndarray) -> np.ndarray:
    """The family of each row of minhashes, by the number of its first row: at least ``ALIKE`` are equal to that row's."""
    first = np.empty(len(signatures), np.int64)  # numbers of the rows that began a family
    leaders = np.empty_like(signatures)
    out, n = np.empty(len(signatures), np.int64), 0
    for k, own in enumerate(signatures):
        equal = (leaders[:n] == own).sum(axis=1)
        best = int(equal.argmax()) if n else 0
        if n and equal[best] >= ALIKE:
            out[k] = first[best]
        else:
            first[n], leaders[n], out[k] = k, own, k
            n += 1
    return out


def _family_weights(rows: DataFrame) -> DataFrame:
    """y, copy, weight: the part of ``WHOLE`` that each row with this signature has (``LABELLED_ROWS`` rows at most)."""
    found = rows.groupBy("y", "copy").agg(F.first("signature").alias("signature"), F.count("*").alias("n")).collect()
    weights = []
    for y in (0, 1):
        own = sorted((r for r in found if r["y"] == y), key=lambda r: r["copy"])
        family = families_of(np.array([r["signature"] for r in own], np.int32).reshape(-1, HASHES))
        sizes = np.bincount(family, [r["n"] for r in own], minlength=len(own))
        weights += [(y, r["copy"], WHOLE // int(sizes[f])) for r, f in zip(own, family.tolist(), strict=True)]
    return rows.sparkSession.createDataFrame(weights, "y int, copy long, weight long")


def features_column(text: Column, lexicon: dict[str, int]) -> Column:
    @F.arrow_udf("array<float>")
    def features(texts: pa.Array) -> pa.Array:
        begin("toxicity")
        return pa.array([features_of(t, lexicon) for t in texts.to_pylist()], pa.list_(pa.float32()))

    return features.asNondeterministic()(text)


@dataclass
class LabelModel:
    """Prior of the toxic class and, for each voter, its parent and P(vote | class, parent's vote)."""

    prior: float
    parents: list[int]
    tables: np.ndarray  # voter, class, vote of the parent (0 for none)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) for rows of votes."""
        logs = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for v, parent in enumerate(self.parents):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            for y in (0, 1):
                p = self.tables[v, y, given]
                logs[:, y] += np.log(np.where(votes[:, v] == 1, p, 1 - p))
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(axis=1)


def fit_label_model(votes: np.ndarray, unlabelled: np.ndarray, known: np.ndarray, rounds: int = 60) -> LabelModel:
    """Expectation maximisation over counted combinations.

    votes: (combinations, voters) of 0 and 1; unlabelled: rows with each; known: rows labelled 0 and 1 with each.
    Without labels, voters are taken to be more frequent among toxic texts.  Dependences within the classes are
    looked for soon and once more when the accuracies have settled.
    """
    voters = votes.shape[1]
    fired = votes.any(axis=1)
    belief = np.where(fired, 0.8, 0.02)
    parents = [-1] * voters
    model = None
    for turn in range(rounds):
        weights = np.stack([(1 - belief) * unlabelled + known[:, 0], belief * unlabelled + known[:, 1]], axis=1)
        if turn in (2, rounds // 2):  # early, else two voters that agree would become the class
            parents = _tree(votes, weights)
        tables = np.full((voters, 2, 2), 0.5)
        for v, parent in enumerate(parents):
            for y in (0, 1):
                for given in (0, 1) if parent >= 0 else (0,):
                    rows = weights[:, y] * (votes[:, parent] == given if parent >= 0 else 1)
                    # pseudo counts: a voter that never fires in a class still may
                    tables[v, y, given] = ((rows * votes[:, v]).sum() + (0.5 if y else 0.05)) / (rows.sum() + 1)
        total = weights.sum(axis=0)
        model = LabelModel(float(np.clip(total[1] / max(total.sum(), 1e-9), 1e-4, 0.5)), parents, tables)
        belief = np.clip(model.posterior(votes), 1e-6, 1 - 1e-6)
    return model


def _tree(votes: np.ndarray, weights: np.ndarray, least: float = 0.005) -> list[int]:
    """Each voter's parent in the forest of largest mutual information within the classes."""
    voters = votes.shape[1]
    edges = []
    share = weights / max(weights.sum(), 1e-9)
    for a in range(voters):
        for b in range(a):
            gain = 0.0
            for y in (0, 1):
                p = np.array([[share[(votes[:, a] == i) & (votes[:, b] == j), y].sum() for j in (0, 1)] for i in (0, 1)])
                each = p.sum()
                if each > 0:
                    apart = np.outer(p.sum(axis=1), p.sum(axis=0)) / each
                    own = p > 0
                    gain += float((p[own] * np.log(p[own] / apart[own])).sum()) / each
            edges.append((gain, a, b))
    links: dict[int, list[int]] = {v: [] for v in range(voters)}
    root = list(range(voters))

    def find(v: int) -> int:
        while root[v] != v:
            v = root[v]
        return v

    for gain, a, b in sorted(edges, reverse=True):
        if gain >= least and find(a) != find(b):
            root[find(a)] = find(b)
            links[a].append(b)
            links[b].append(a)
    parents, seen = [-1] * voters, set()
    for start in range(voters):
        waiting = [] if start in seen else [start]
        seen.add(start)
        while waiting:
            v = waiting.pop()
            for other in links[v]:
                if other not in seen:
                    seen.add(other)
                    parents[other] = v
                    waiting.append(other)
    return parents


@dataclass
class ToxicityModel:
    lexicon: dict[str, int]
    labels: LabelModel
    weights: np.ndarray
    intercept: float

    def score_column(self, features: Column) -> Column:
        """The linear classifier's probability, from built-in functions."""
        total = F.lit(self.intercept)
        for k, weight in enumerate(self.weights):
            total = total + F.lit(float(weight)) * features[k].cast("double")
        return 1 / (1 + F.exp(-total))


def _pattern(features: Column) -> Column:
    number = F.lit(0)
    for k in range(VOTERS):
        number = number + features[k].cast("int") * F.lit(1 << k)
    return number


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[ToxicityModel, DataFrame]:
    """The model, and the table (doc_id, features) of all rows of ``docs`` it was trained on.

    ``labels`` holds the rows to learn from; null ids and labels other than 0 and 1 teach nothing.  Without labels
    the seed lexicon and the votes alone decide; without documents nothing is trained and the scores stay low.
    """
    own = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and id is not null")
    lexicon = learn_lexicon(own, known)
    table = stored(own.select("id", features_column(F.col("text"), lexicon).alias("x")).withColumn("votes", _pattern(F.col("x"))))
    counted = {r["votes"]: r["n"] for r in table.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    anchors = table.join(known, "id").groupBy("votes", "y").agg(F.count("*").alias("n")).collect()
    numbers = sorted(counted)  # at most 2 ** VOTERS
    votes = np.array([[n >> k & 1 for k in range(VOTERS)] for n in numbers], np.int64).reshape(-1, VOTERS)
    everyone = np.array([counted[n] for n in numbers], float)
    sure = np.zeros((len(numbers), 2))
    for r in anchors:
        sure[numbers.index(r["votes"]), r["y"]] += r["n"]
    if not numbers:
        empty = LabelModel(0.01, [-1] * VOTERS, np.full((VOTERS, 2, 2), 0.5))
        return ToxicityModel(lexicon, empty, np.zeros(2 * VOTERS + 1), -5.0), table
    label_model = fit_label_model(votes, np.maximum(everyone - sure.sum(axis=1), 0), sure)
    beliefs = {n: float(p) for n, p in zip(numbers, label_model.posterior(votes))}
    belief = F.create_map([F.lit(x) for pair in beliefs.items() for x in pair])[F.col("votes")]
    belief = F.coalesce(F.col("y").cast("double"), belief)  # the posterior of a labelled row is its label
    classes = F.explode(F.array(F.struct(F.lit(0.0).alias("label"), (1 - belief).alias("weight")), F.struct(F.lit(1.0).alias("label"), belief.alias("weight"))))
    # rows that look the same to the classifier are one weighted row
    one = known.groupBy("id").agg(F.max("y").alias("y"))
    same = table.join(one, "id", "left").groupBy("x", "votes", "y").agg(F.count("*").alias("n"))
    rows = same.select("x", "n", classes.alias("c")).select(
        array_to_vector(F.col("x").cast("array<double>")).alias("features"), "c.label", (F.col("c.weight") * F.col("n")).alias("weight")
    ).filter("weight > 0")
    trained = LogisticRegression(weightCol="weight", regParam=1e-5, maxIter=40).fit(stored(rows))
    return ToxicityModel(lexicon, label_model, trained.coefficients.toArray(), float(trained.intercept)), table


def score_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """doc_id and score (probability of toxic) of every row of ``docs``.

    Repeated rows stay; a null or empty text gets the score of a text in which no voter saw anything.
    """
    model, table = fit(docs, labels, id, text, label)
    return table.select(F.col("id").alias("doc_id"), model.score_column(F.col("x")).alias("score"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their columns as they were."""
    name = temporary("features")
    scored = docs.withColumn(name, features_column(F.col(text), model.lexicon))
    return scored.filter(model.score_column(F.col(name)) < threshold).drop(name)
