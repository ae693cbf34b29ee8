"""The player snapshot table from files to rating models.

The questions and the preparation use the fixed column names of the player schema;
everything else is the general operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions import field
from perennia.operators import analytics, clean, features, models, outliers, quality, split, stats
from perennia.operators.mlp import MLPConfig, train_mlp
from perennia.sources import files
from perennia.sources.schema import conform, player_file_schema, player_schema
from perennia.sources.scratch import stored

# The columns the rating models use, and how they are coded.
LABEL = "overall"
NOMINAL = ["preferred_foot", "gender"]
PROFILE = ["potential", "age", "height_cm", "weight_kg", "weak_foot", "international_reputation", "year"]
SUMMARY_RATINGS = ["pace", "shooting", "passing", "dribbling", "defending", "physic"]
SKILL_PREFIXES = ("attacking_", "skill_", "movement_", "power_", "mentality_", "defending_", "goalkeeping_")
UNUSED_SKILLS = ["goalkeeping_speed"]
CODES = {"gender": {"M": 1, "F": 0}, "preferred_foot": {"Right": 1, "Left": 0}}
IMPUTED = [*SUMMARY_RATINGS, "mentality_composure"]
ENTITY = ["sofifa_id", "long_name"]


def _between(first: str, last: str) -> list[str]:
    names = player_schema().names
    return names[names.index(first) : names.index(last) + 1]


POSITION_RATINGS = _between("ls", "gk")
_USED = {LABEL, *NOMINAL, *PROFILE, *SUMMARY_RATINGS, *POSITION_RATINGS}
SELECTED = [
    name
    for name in player_schema().names
    if (name in _USED or name.startswith(SKILL_PREFIXES)) and name not in UNUSED_SKILLS
]
CONTINUOUS = [name for name in SELECTED if name != LABEL and name not in NOMINAL]


def read_players(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All yearly files under a glob, one scan, in the declared types; ``NA`` becomes null."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in player_file_schema()])
    return conform(files.read_snapshots(spark, path, as_text), player_schema())


def _men(players: DataFrame) -> DataFrame:
    return players.filter(F.col("gender") == "M")


def top_contract_clubs(players: DataFrame, joined_by: int, clubs: int, until_at_least: int, **options) -> DataFrame:
    """Clubs with most male players who joined by one year under contract until another."""
    return analytics.top_groups_by_contract(
        _men(players),
        joined_by,
        clubs,
        until_at_least,
        entity=ENTITY,
        group="club_name",
        joined="club_joined",
        until="club_contract_valid_until",
        period="year",
        name="players_count",
        **options,
    )


def average_age_clubs(players: DataFrame, clubs: int, year: int, highest: bool = True, **options) -> DataFrame:
    """Clubs with the highest or lowest average male age in a year; a negative number asks for the lowest."""
    rows = _men(players).filter(F.col("year") == year)
    return analytics.extreme_groups_by_avg(
        rows, clubs, group="club_name", measure="age", highest=highest, name="avg_age", **options
    )


def top_nationality_by_year(players: DataFrame, **options) -> DataFrame:
    return analytics.mode_per_group(_men(players), "year", "nationality_name", name="nationality_count", **options)


def leading_nationalities(players: DataFrame, year: int, n: int = 5) -> DataFrame:
    """The n most frequent nationalities of one year; only that year is read and counted."""
    rows = _men(players).filter(F.col("year") == year)
    return analytics.top_values_per_group(rows, "year", "nationality_name", n, name="nationality_count")


def nationality_ranking(players: DataFrame) -> DataFrame:
    return analytics.rank_values_in_group(_men(players), "year", "nationality_name", name="nationality_count")


def prepare_players(players: DataFrame, sparse_threshold: float = 0.5) -> DataFrame:
    """Model columns only, all numeric: sparse columns dropped, gaps filled, texts parsed.

    Two jobs: one for the missing ratios, one for the means.  A model column that is
    sparse is left out, and the features are those that remain.
    """
    kept = quality.drop_sparse(players.select(*[field(c) for c in SELECTED]), sparse_threshold)
    imputed = [c for c in IMPUTED if c in kept.columns]
    filled = clean.impute_mean(kept, imputed, means=clean.column_means(kept, imputed))
    parsed = clean.parse_ratings(filled, [c for c in POSITION_RATINGS if c in kept.columns])
    coded = clean.encode_columns(parsed, {c: m for c, m in CODES.items() if c in kept.columns})
    whole = [c for c in ["mentality_composure"] if c in kept.columns]
    return quality.select_by_type(clean.truncate_to_int(coded, whole), ["int", "double"])


def drop_outlier_players(prepared: DataFrame, max_flags: int = 10, ints_only: bool = False) -> DataFrame:
    """Rows with at most ``max_flags`` outlying values.

    By default the label and two-valued columns are not tested.  ``ints_only`` tests
    every int column instead, the label, the year and the two codes included.  The rows are
    stored once, for the passes that fit the bounds.
    """
    prepared = stored(prepared)
    cols = outliers.outlier_columns(prepared, exclude=() if ints_only else (LABEL,), ints_only=ints_only)
    bounds = outliers.outlier_bounds(prepared, cols)
    return outliers.drop_outlier_rows(prepared, bounds, max_flags, skip_two_valued=not ints_only)


def rating_pipeline(columns: Sequence[str], with_mean: bool = False) -> Pipeline:
    """Feature pipeline over the model columns present in a prepared table."""
    return features.feature_pipeline(
        [c for c in CONTINUOUS if c in columns],
        [c for c in NOMINAL if c in columns],
        LABEL,
        with_mean=with_mean,
        nulls="skip",
    )


def train_ratings(
    table: DataFrame, network: MLPConfig | None = None, seed: int = 66, keys: Sequence[str] | None = None
) -> tuple[dict[str, object], DataFrame]:
    """Linear, tree and (given a config) network models, and their metrics on both parts.

    The parts come from a hash of ``keys`` (default: all columns).  The table is written
    to the scratch folder first, so that the many passes of the trainers read its model
    columns instead of preparing them again.
    """
    table = stored(table)
    train, test = split.hash_split(table, keys, (0.8, 0.2), seed)
    fitted = rating_pipeline(table.columns).fit(train)
    parts = {"train": fitted.transform(train), "test": fitted.transform(test)}
    trained: dict[str, object] = {
        "pipeline": fitted,
        "linear": models.fit_linear(parts["train"]),
        "tree": models.fit_tree(parts["train"]),
    }
    scored = {name: [models.score(trained[name], part) for part in parts.values()] for name in ("linear", "tree")}
    if network is not None:
        centred = rating_pipeline(table.columns, with_mean=True).fit(train)
        trained["network_pipeline"] = centred
        trained["network"] = train_mlp(centred.transform(train), network)
        scored["network"] = [
            trained["network"].predict(centred.transform(part)).select("target", "prediction") for part in (train, test)
        ]
    labelled = [
        frame.select(F.lit(name).alias("model"), F.lit(part).alias("split"), "target", "prediction")
        for name, frames in scored.items()
        for part, frame in zip(parts, frames)
    ]
    return trained, stats.regression_metrics(files.union_all(labelled), by=["model", "split"])
