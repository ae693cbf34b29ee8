"""Declared schemas, conforming a table to one, and the fixed player snapshot schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from perennia.functions import field, missing, safe_cast

# The columns and types of a player snapshot, in file order.  The last
# two come from the file name.
PLAYER_SNAPSHOT_COLUMNS = """
    sofifa_id INT, player_url STRING, short_name STRING, long_name STRING,
    player_positions STRING, overall INT, potential INT, value_eur DOUBLE, wage_eur DOUBLE,
    age INT, dob DATE, height_cm INT, weight_kg INT, club_team_id DOUBLE, club_name STRING,
    league_name STRING, league_level INT, club_position STRING, club_jersey_number INT,
    club_loaned_from STRING, club_joined DATE, club_contract_valid_until INT,
    nationality_id INT, nationality_name STRING, nation_team_id DOUBLE, nation_position STRING,
    nation_jersey_number INT, preferred_foot STRING, weak_foot INT, skill_moves INT,
    international_reputation INT, work_rate STRING, body_type STRING, real_face STRING,
    release_clause_eur STRING, player_tags STRING, player_traits STRING, pace INT, shooting INT,
    passing INT, dribbling INT, defending INT, physic INT, attacking_crossing INT,
    attacking_finishing INT, attacking_heading_accuracy INT, attacking_short_passing INT,
    attacking_volleys INT, skill_dribbling INT, skill_curve INT, skill_fk_accuracy INT,
    skill_long_passing INT, skill_ball_control INT, movement_acceleration INT,
    movement_sprint_speed INT, movement_agility INT, movement_reactions INT,
    movement_balance INT, power_shot_power INT, power_jumping INT, power_stamina INT,
    power_strength INT, power_long_shots INT, mentality_aggression INT,
    mentality_interceptions INT, mentality_positioning INT, mentality_vision INT,
    mentality_penalties INT, mentality_composure STRING, defending_marking_awareness INT,
    defending_standing_tackle INT, defending_sliding_tackle INT, goalkeeping_diving INT,
    goalkeeping_handling INT, goalkeeping_kicking INT, goalkeeping_positioning INT,
    goalkeeping_reflexes INT, goalkeeping_speed INT, ls STRING, st STRING, rs STRING,
    lw STRING, lf STRING, cf STRING, rf STRING, rw STRING, lam STRING, cam STRING, ram STRING,
    lm STRING, lcm STRING, cm STRING, rcm STRING, rm STRING, lwb STRING, ldm STRING,
    cdm STRING, rdm STRING, rwb STRING, lb STRING, lcb STRING, cb STRING, rcb STRING,
    rb STRING, gk STRING, player_face_url STRING, club_logo_url STRING, club_flag_url STRING,
    nation_logo_url STRING, nation_flag_url STRING, year INT, gender STRING
"""
FILE_NAME_COLUMNS = ("year", "gender")


_TYPES = {"INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "DATE": T.DateType()}


def player_schema() -> T.StructType:
    pairs = [column.split() for column in PLAYER_SNAPSHOT_COLUMNS.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def player_file_schema() -> T.StructType:
    """The part of the player schema that the files themselves hold."""
    return T.StructType([f for f in player_schema() if f.name not in FILE_NAME_COLUMNS])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types.

    Values that do not fit become null (count them with ``conform_losses``); a column
    the table lacks is null throughout; other columns are left out.
    """
    present = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (
                safe_cast(field(f.name), present[f.name], f.dataType)
                if f.name in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema
        ]
    )


def conform_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(column_name, lost): present values that conforming would turn into null."""
    present = {f.name: f.dataType for f in df.schema}
    lost = {
        f.name: F.count_if(
            ~missing(df, f.name) & safe_cast(field(f.name), present[f.name], f.dataType).isNull()
        )
        for f in schema
        if f.name in present
    }
    return one_row_per_column(df, lost, "lost")


def one_row_per_column(
    df: DataFrame,
    aggregates: Mapping[str, Column],
    value_name: str,
    shared: Mapping[str, Column] | None = None,
    labels: Mapping[str, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """One pass over ``df``: an aggregate per column, turned into a row per column.

    ``shared`` aggregates (such as the row count) are computed once and repeated;
    ``labels`` are constants to carry in a column's row.
    """
    shared = dict(shared or {})
    labels = labels or {}
    names = list(aggregates)
    totals = df.agg(
        *[aggregates[name].alias(f"c{i}") for i, name in enumerate(names)],
        *[column.alias(f"s_{name}") for name, column in shared.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"c{i}").alias(value_name),
                *[F.col(f"s_{extra}").alias(extra) for extra in shared],
                *[constant.alias(label) for label, constant in labels.get(name, {}).items()],
            )
            for i, name in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows))


def small_table(spark: SparkSession, rows: Sequence[Mapping[str, object]], ddl: str) -> DataFrame:
    """A table of fitted statistics: a handful of rows, one per column or epoch."""
    arrow_schema = to_arrow_schema(T.StructType.fromDDL(ddl))
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=arrow_schema))
