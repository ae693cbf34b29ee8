"""The whole player flow on generated snapshot files, checked against pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from helpers import rows, unordered
from pyspark.sql import functions as F

from perennia.operators import outliers, quality
from perennia.operators.mlp import MLPConfig
from perennia.plans import players as p
from perennia.sources.schema import player_file_schema, player_schema

YEARS = {
    "players_15.csv": (2015, "M", 150),
    "players_16.csv": (2016, "M", 160),
    "female_players_16.csv": (2016, "F", 40),
}


def snapshot(seed: int, n: int) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    skill = rng.normal(62, 9, n)
    columns = {}
    for field in player_file_schema():
        name, kind = field.name, field.dataType.simpleString()
        if name in p.POSITION_RATINGS:
            base = np.clip(skill + rng.normal(0, 4, n), 20, 95).astype(int)
            columns[name] = [f"{b}{rng.choice(['+3', '+2', '-1', ''])}" for b in base]
        elif kind == "int":
            columns[name] = np.clip(skill + rng.normal(0, 5, n), 1, 99).astype(int)
        elif kind == "double":
            columns[name] = rng.integers(1, 5000, n).astype(float)
        elif kind == "date":
            parts = zip(rng.integers(2008, 2019, n), rng.integers(1, 9, n), rng.integers(0, 9, n))
            columns[name] = [f"{y}-0{m}-1{d}" for y, m, d in parts]
        else:
            columns[name] = [f"{name} {v}" for v in rng.integers(0, 6, n)]
    frame = pd.DataFrame(columns)
    frame["sofifa_id"] = np.arange(n)
    frame["long_name"] = [f"Player, {i}" for i in range(n)]
    frame["overall"] = np.clip(skill, 30, 95).astype(int)
    frame["club_contract_valid_until"] = rng.integers(2019, 2027, n)
    frame["age"] = rng.integers(17, 39, n)
    frame["preferred_foot"] = rng.choice(["Right", "Left"], n, p=[0.7, 0.3])
    frame["mentality_composure"] = [str(v) for v in frame["mentality_vision"]]
    for name in ("pace", "mentality_composure"):
        frame[name] = frame[name].astype(object)
        frame.loc[rng.random(n) < 0.1, name] = "NA"
    frame.loc[rng.random(n) < 0.8, "goalkeeping_speed"] = None
    frame.loc[rng.random(n) < 0.1, "club_name"] = None
    frame.loc[0, [c for c in p.CONTINUOUS if c.startswith(("attacking", "power", "movement", "defending_"))]] = 5000
    return frame


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("players")
    frames = []
    for seed, (name, (year, gender, n)) in enumerate(YEARS.items()):
        frame = snapshot(seed, n)
        frame.to_csv(folder / name, index=False)
        frames.append(frame.assign(year=year, gender=gender))
    return p.read_players(spark, f"{folder}/*.csv").cache(), pd.concat(frames, ignore_index=True)


def test_read_is_typed(table):
    frame, pdf = table
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in player_schema()]
    assert frame.count() == len(pdf)
    assert frame.filter("pace is null").count() == int((pdf["pace"] == "NA").sum())
    assert frame.filter("club_joined is null").count() == 0
    assert frame.filter("goalkeeping_speed is not null").count() == int(pdf["goalkeeping_speed"].notna().sum())


def test_profile_of_all_columns(table):
    frame, pdf = table
    missing = {r.column_name: r.missing for r in quality.missing_ratio(frame).collect()}
    lacking = pdf.isna() | (pdf == "NA")
    assert missing == {c: int(lacking[c].sum()) for c in frame.columns}
    assert [r.column_name for r in quality.sparse_columns(frame).collect()] == ["goalkeeping_speed"]


def test_contract_question(table):
    frame, pdf = table
    joined = pdf.club_joined.str[:4].astype(int)
    men = pdf[(pdf.gender == "M") & (pdf.club_contract_valid_until >= 2023) & (joined <= 2014)]
    newest = men.sort_values("year", ascending=False).drop_duplicates(["sofifa_id", "long_name"])
    counts = newest.groupby("club_name", dropna=False).size().reset_index(name="n")
    counts["key"] = counts["club_name"].fillna("")
    want = counts.sort_values(["n", "key"], ascending=[False, True]).head(5)
    got = rows(p.top_contract_clubs(frame, 2014, 5, 2023))
    assert got == [(None if pd.isna(c) else c, n) for c, n in zip(want["club_name"], want["n"])]


@pytest.mark.parametrize("highest", [True, False])
def test_age_question(table, highest):
    frame, pdf = table
    rows_2016 = pdf[(pdf.gender == "M") & (pdf.year == 2016)]
    means = rows_2016.groupby("club_name", dropna=False)["age"].mean().sort_values(ascending=not highest)
    got = rows(p.average_age_clubs(frame, 3, 2016, highest))
    assert [a for _, a in got] == pytest.approx(list(means.head(3)))
    assert rows(p.average_age_clubs(frame, -3, 2016)) == rows(p.average_age_clubs(frame, 3, 2016, False))
    assert rows(p.average_age_clubs(frame, 3, 1999)) == []


def test_nationality_question(table):
    frame, pdf = table
    counts = pdf[pdf.gender == "M"].groupby(["year", "nationality_name"]).size().reset_index(name="n")
    ordered = counts.sort_values(["year", "n", "nationality_name"], ascending=[True, False, True])
    firsts = ordered.drop_duplicates("year")
    assert unordered(p.top_nationality_by_year(frame)) == sorted(map(tuple, firsts.itertuples(index=False)))
    year = ordered[ordered.year == 2016].head(3)
    got = p.leading_nationalities(frame, 2016, 3).orderBy("rank")
    found = [(r.nationality_name, r.nationality_count) for r in got.collect()]
    assert found == list(zip(year["nationality_name"], year["n"]))
    assert p.nationality_ranking(frame).count() == len(counts)


def test_preparation(table):
    frame, pdf = table
    prepared = p.prepare_players(frame)
    assert prepared.columns == p.SELECTED
    assert {t for _, t in prepared.dtypes} == {"int", "double"}
    got = prepared.toPandas()
    assert not got.isna().any().any()
    pace = pd.to_numeric(pdf["pace"], errors="coerce")
    assert got["pace"].sum() == pytest.approx(pace.fillna(pace.mean()).sum())
    composure = pd.to_numeric(pdf["mentality_composure"], errors="coerce")
    assert got["mentality_composure"].sum() == composure.fillna(composure.mean()).astype(int).sum()
    assert got["gk"].sum() == pdf["gk"].str.extract(r"^(\d+)")[0].astype(int).sum()
    assert got["gender"].sum() == (pdf["gender"] == "M").sum()


def test_sparse_model_column_is_left_out(spark, table):
    frame, _ = table
    prepared = p.prepare_players(frame.withColumn("pace", F.lit(None).cast("int")))
    assert "pace" not in prepared.columns and "shooting" in prepared.columns


@pytest.mark.parametrize("ints_only", [True, False])
def test_outlier_rows_go(table, ints_only):
    frame, _ = table
    prepared = p.prepare_players(frame).cache()
    pdf = prepared.toPandas()
    cols = outliers.outlier_columns(prepared, () if ints_only else ("overall",), ints_only)
    flags = pd.Series(0, index=pdf.index)
    for c in cols:
        if not ints_only and pdf[c].nunique() <= 2:
            continue
        q1, q3 = np.quantile(pdf[c], [0.25, 0.75], method="inverted_cdf")
        flags += ((pdf[c] < q1 - 1.5 * (q3 - q1)) | (pdf[c] > q3 + 1.5 * (q3 - q1))).astype(int)
    kept = p.drop_outlier_players(prepared, ints_only=ints_only)
    assert kept.count() == int((flags <= 10).sum()) < len(pdf)


def test_models(table):
    frame, _ = table
    final = p.drop_outlier_players(p.prepare_players(frame)).cache()
    trained, metrics = p.train_ratings(final, MLPConfig(hidden=(16,), epochs=2, workers=2, learning_rate=1e-2))
    got = {(r.model, r.split): r for r in metrics.collect()}
    assert set(got) == {(m, s) for m in ("linear", "tree", "network") for s in ("train", "test")}
    assert sum(got["linear", s].n for s in ("train", "test")) == final.count()
    assert got["linear", "train"].mse < 2 and got["tree", "train"].r2 > 0.9
    assert trained["tree"].depth <= 12
    assert trained["linear"].numFeatures == 77
