"""Quality scores by random Fourier features, ridge regression and isotonic calibration.

One pass turns each whole text into some thirty statistics.  Standardised, they are mapped to cosines of random
directions, whose products approximate a Gaussian kernel.  Every partition of labelled rows sums its normal equations
for each of five folds; the sums are added in two rounds of grouping, and the driver solves small systems.  Scores of
the fold that a model has not seen are counted in bins and made monotone (pool adjacent violators).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import batch, temporary
from perennia.sources.scratch import stored

#: Random directions, ridge penalty for a row, width of the kernel, folds and bins of the calibration.
FEATURES, RIDGE, WIDTH, FOLDS, BINS = 256, 1e-3, 6.0, 5, 1000
#: Statistics of a text, see ``statistics_of``.
STATISTICS = 26

_WORD = re.compile(r"\w+")


def statistics_of(text: str | None) -> list[float]:
    """Counts and shares of a whole text; all zero for null and empty ones."""
    if not text:
        return [0.0] * STATISTICS
    n, tokens, lines = len(text), text.split(), [x for x in text.split("\n") if x.strip()]
    w, raw = max(1, len(tokens)), text.encode()
    counts = Counter(tokens)
    letters, upper = max(1, _letters(text)), _uppers(text)
    words = _WORD.findall(text)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    repeats = sum(a == b for a, b in zip(tokens, tokens[1:]))
    pairs = len(set(zip(tokens, tokens[1:])))
    line_counts = Counter(lines)
    several = sum(c for c in line_counts.values() if c > 1)
    ends = sum(x.rstrip()[-1] in ".!?:;\"'" for x in lines)
    packed = len(zlib.compress(raw, 1))
    return [
        np.log1p(n),
        np.log1p(len(tokens)),
        np.log1p(len(lines)),
        float(lengths.mean()) if len(tokens) else 0.0,
        float(lengths.std()) if len(tokens) else 0.0,
        np.log1p(float(lengths.max())) if len(tokens) else 0.0,
        letters / n,
        upper / letters,
        sum(text.count(d) for d in "0123456789") / n,
        sum(text.count(c) for c in "$%&#*@^~<>{}[]\\/=+_") / n,
        text.count("|") / w,
        text.count("!") / w,
        text.count("?") / w,
        text.count(",") / w,
        text.count(".") / w,
        len(counts) / w,
        max(counts.values(), default=0) / w,
        repeats / w,
        pairs / w,
        several / max(1, len(lines)),
        ends / max(1, len(lines)),
        packed / len(raw),
        len(words) / w,
        sum(counts[x] for x in counts if len(x) <= 3) / w,
        text.count("http") / w,
        w / max(1, text.count(". ") + text.count(".\n") + 1) / 20,
    ]


def _letters(text: str) -> int:
    """Characters of words that are no digits and no underscores."""
    return len(text) - len(re.sub(r"[^\W\d_]", "", text))


def _uppers(text: str) -> int:
    """Characters that lower case changes."""
    lower = text.lower()
    if len(lower) != len(text):  # some become several
        return sum(c.lower() != c for c in text)
    a, b = (np.frombuffer(x.encode("utf-32-le", "replace"), np.uint32) for x in (text, lower))
    return int((a != b).sum())


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def statistics(texts: pa.Array) -> pa.Array:
        return pa.array([statistics_of(t) for t in texts.to_pylist()], pa.list_(pa.float32()))

    return statistics.asNondeterministic()(text)


@dataclass
class QualityModel:
    """Standardisation, directions, ridge weights and the calibrated value of each bin of raw scores."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    low: float
    high: float
    calibrated: np.ndarray

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return cosines(statistics, self) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return self.calibrated[bins(self.raw(statistics), self.low, self.high)]


def cosines(statistics: np.ndarray, model: QualityModel) -> np.ndarray:
    """The random features and a constant."""
    z = np.clip((statistics - model.mean) / model.scale, -8, 8) @ model.directions + model.phases
    return np.hstack([np.sqrt(2 / z.shape[1]) * np.cos(z), np.ones((len(z), 1))])


def bins(raw: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.clip(((raw - low) / (high - low) * BINS).astype(np.int64), 0, BINS - 1)


def monotone(ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The nearest values that never fall from bin to bin (pool adjacent violators); empty bins lie between."""
    used = np.flatnonzero(counts)
    blocks: list[list[float]] = []  # ones, count, bins
    for k in used:
        blocks.append([float(ones[k]), float(counts[k]), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    values = np.concatenate([[o / c] * int(n) for o, c, n in blocks])
    return np.interp(np.arange(len(counts)), used, values)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def _add_up(parts: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """The sums of the blocks that partitions made, added in two rounds; one block of each kind reaches the driver."""

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b) for b in rows["sums"]], axis=0)
        return rows.head(1).assign(sums=[total.tobytes()])

    schema = parts.schema
    once = parts.groupBy("fold", "block", "part").applyInPandas(added, schema)
    whole = once.groupBy("fold", "block").applyInPandas(added, schema)
    return {(r.fold, r.block): np.frombuffer(r.sums) for r in whole.collect()}


def fit(table: DataFrame, labels: DataFrame, statistics: str = "statistics", id: str = "doc_id", label: str = "quality", seed: int = 11) -> QualityModel | None:
    """A model from the rows of ``table`` (id and statistics) that have a label of 0 or 1; None without any.

    Rows with null ids or labels teach nothing; a document with several label rows counts once for each.
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("double").alias("y")).filter("y in (0, 1)")
    rows = table.select(F.col(id).alias("id"), F.col(statistics).alias("x")).join(known, "id")
    rows = stored(rows.select("x", "y", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int").alias("fold")))
    columns = [F.col("x")[k].cast("double") for k in range(STATISTICS)]
    about = rows.agg(
        F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}{k}") for k, c in enumerate(columns) for f in (F.avg, F.stddev_pop)]
    ).first()
    if not about["n"]:
        return None
    random = np.random.default_rng(seed)
    scale = np.array([about[f"stddev_pop{k}"] for k in range(STATISTICS)])
    model = QualityModel(
        mean=np.array([about[f"avg{k}"] for k in range(STATISTICS)]),
        scale=np.where(scale > 1e-9, scale, 1.0),
        directions=random.normal(size=(STATISTICS, FEATURES)) / WIDTH,
        phases=random.uniform(0, 2 * np.pi, FEATURES),
        weights=np.zeros(FEATURES + 1),
        low=-0.5,
        high=1.5,
        calibrated=np.zeros(BINS),
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for b in batches:
            z, y, fold = cosines(_matrix(b[0]), model), b[1].to_numpy(), b[2].to_numpy()
            for k in np.unique(fold):
                own = fold == k
                total[k] += z[own].T @ np.hstack([z[own], y[own, None]])
        part = TaskContext.get().partitionId() % 64
        blocks = np.array_split(np.arange(FEATURES + 1), 8)
        out = [(k, n, part, total[k][own].tobytes()) for k in range(FOLDS) for n, own in enumerate(blocks)]
        made = list(zip(*out, strict=True))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        names = ("fold", "block", "part", "sums")
        yield batch({n: pa.array(c, t) for n, c, t in zip(names, made, types, strict=True)})

    found = _add_up(rows.mapInArrow(sums, "fold int, block int, part int, sums binary"))
    folds = [
        np.vstack([found[k, n].reshape(-1, FEATURES + 2) for n in range(8)]) for k in range(FOLDS)
    ]
    whole = np.sum(folds, axis=0)

    def solved(equations: np.ndarray) -> np.ndarray:
        penalty = RIDGE * max(1.0, equations[-1, -2]) * np.eye(FEATURES + 1)
        penalty[-1, -1] = 1e-9
        return np.linalg.solve(equations[:, :-1] + penalty, equations[:, -1])

    apart = np.array([solved(whole - own) for own in folds])

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = (cosines(_matrix(b[0]), model) * apart[b[2].to_numpy()]).sum(axis=1)
            yield batch({"bin": pa.array(bins(raw, model.low, model.high)), "y": b[1]})

    counted = rows.mapInArrow(unseen, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("ones"), F.count("*").alias("n"))
    ones, counts = np.zeros(BINS), np.zeros(BINS)
    for r in counted.collect():  # a row for each bin at most
        ones[r["bin"]], counts[r["bin"]] = r["ones"], r["n"]
    model.weights, model.calibrated = solved(whole), np.clip(monotone(ones, counts), 0, 1)
    return model


def score_column(statistics: Column, model: QualityModel | None) -> Column:
    """Calibrated probability of label 1; 0.5 where there was nothing to learn from."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(rows)) if len(rows) else [], pa.float64())

    return scored(statistics)


def score_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id and score of every row of ``docs``; repeated rows stay, null and empty texts are scored as such.

    ``labels`` are the rows to learn from.  Other columns of either table are not looked at.
    """
    name = temporary("statistics")
    table = stored(docs.select(F.col(id).alias("doc_id"), statistics_column(F.col(text)).alias(name)))
    known = labels.select(F.col(id).alias("doc_id"), F.col(label).alias("label"))
    model = fit(table, known, name, "doc_id", "label")
    return table.select("doc_id", score_column(F.col(name), model).alias("score"))
