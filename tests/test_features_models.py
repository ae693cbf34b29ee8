from __future__ import annotations

import numpy as np
import pytest
from helpers import plan, rows, unordered
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from perennia.operators import features, models, stats


@pytest.fixture(scope="module")
def model_rows(spark):
    rng = np.random.default_rng(4)
    data = [
        (i, float(a), float(b), ("x", "y", "y", "z", "z", "z")[i % 6], float(3 * a - 2 * b + 7))
        for i, (a, b) in enumerate(rng.normal(5, 2, (300, 2)))
    ]
    return spark.createDataFrame(data, "key int, x1 double, x2 double, f string, label double")


def test_pipeline_layout_and_scaling(model_rows):
    fitted = features.feature_pipeline(["x1", "x2"], ["f"], "label").fit(model_rows)
    out = features.features_to_array(fitted.transform(model_rows))
    assert out.columns == ["key", "features", "target"]
    matrix = np.array([r.features for r in out.orderBy("key").collect()])
    source = np.array([(r.x1, r.x2, r.f == "z", r.f == "y") for r in model_rows.orderBy("key").collect()], float)
    assert matrix.shape == (300, 4)
    assert np.allclose(matrix, source / source.std(axis=0, ddof=1))
    centred = features.feature_pipeline(["x1", "x2"], ["f"], "label", with_mean=True).fit(model_rows)
    scaled = np.array([r.features for r in features.features_to_array(centred.transform(model_rows)).collect()])
    assert np.allclose(scaled.mean(axis=0), 0, atol=1e-9)


def test_pipeline_options(spark, model_rows):
    pipeline = features.feature_pipeline(
        ["x1", "x2"], ["f"], "label", unseen="keep", nulls="skip", keep_inputs=True
    )
    fitted = pipeline.fit(model_rows)
    odd = spark.createDataFrame(
        [(1, 1.0, 2.0, "new", 1.0), (2, None, 2.0, "x", 1.0)], "key int, x1 double, x2 double, f string, label double"
    )
    out = fitted.transform(odd)
    assert [r.key for r in out.collect()] == [1]
    assert {"x1", "x2", "f"} <= set(out.columns)
    strict = features.feature_pipeline(["x1", "x2"], ["f"], "label").fit(model_rows)
    with pytest.raises(Exception):
        strict.transform(odd).collect()


def test_text_numbers_are_cast(spark):
    frame = spark.createDataFrame([("1", 2), ("3", 4), ("NA", 5)], "a string, y int")
    cast = features.TypeCaster(columns=["a"]).transform(frame)
    assert rows(cast.select("a")) == [(1.0,), (3.0,), (None,)]
    labelled = features.LabelMaker(source="y").transform(frame)
    assert labelled.dtypes == [("a", "string"), ("target", "double")]
    assert features.ColumnDropper(columns=["a"]).transform(frame).columns == ["y"]


def test_pipeline_can_be_saved(spark, model_rows, tmp_path):
    fitted = features.feature_pipeline(["x1", "x2"], ["f"], "label").fit(model_rows)
    models.save_model(fitted, f"{tmp_path}/p")
    loaded = models.load_model(spark, f"{tmp_path}/p")
    assert isinstance(loaded, PipelineModel)
    assert rows(loaded.transform(model_rows).orderBy("key")) == rows(fitted.transform(model_rows).orderBy("key"))
    # Rows to score need no label.
    assert "target" not in loaded.transform(model_rows.drop("label")).columns


def test_linear_model_is_exact(spark, model_rows, tmp_path):
    prepared = features.feature_pipeline(["x1", "x2"], [], "label").fit(model_rows).transform(model_rows)
    linear = models.fit_linear(prepared)
    scored = models.score(linear, prepared, ["key"])
    assert scored.columns == ["key", "target", "prediction"]
    assert stats.regression_metrics(scored).first().mse < 1e-15
    residuals = scored.select(F.sum(F.col("target") - F.col("prediction"))).first()[0]
    assert abs(residuals) < 1e-6
    models.save_model(linear, f"{tmp_path}/m")
    again = models.load_model(spark, f"{tmp_path}/m")
    assert np.allclose(again.coefficients.toArray(), linear.coefficients.toArray())


def test_tree_respects_depth_and_reduces_variance(spark, model_rows, tmp_path):
    prepared = features.feature_pipeline(["x1", "x2"], ["f"], "label").fit(model_rows).transform(model_rows)
    tree = models.fit_tree(prepared, max_depth=12)
    assert tree.depth <= 12
    metrics = stats.regression_metrics(models.score(tree, prepared)).first()
    variance = prepared.select(F.var_pop("target")).first()[0]
    assert metrics.mse < 0.2 * variance
    models.save_model(tree, f"{tmp_path}/t")
    again = models.load_model(spark, f"{tmp_path}/t")
    assert rows(models.score(again, prepared, ["key"]).orderBy("key")) == rows(
        models.score(tree, prepared, ["key"]).orderBy("key")
    )


def test_string_index_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("b",), ("d",)], "s string")
    model = features.string_indexer(["s"]).fit(frame)
    assert model.labels == ["b", "c", "a", "d"]


def test_index_table_equals_the_indexer(spark):
    data = [(k, v) for k, v in enumerate(["b", "a", "b", "c", "a", "b", "d"])]
    frame = spark.createDataFrame(data, "k int, v string").repartition(3)
    want = features.string_indexer(["v"]).fit(frame).transform(frame)
    made = features.index_table(frame, "v")
    assert unordered(made.transform(frame)) == unordered(want.select("k", "v", "v_index")) and made.size == 4
    other = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "k int, v string")
    assert unordered(made.transform(other, unseen="keep").select("k", "v_index")) == [(1, 1.0), (2, 4.0), (3, 4.0)]
    assert unordered(made.transform(other, unseen="skip").select("k", "v_index")) == [(1, 1.0)]
    with pytest.raises(Exception, match="has no index: z"):
        made.transform(other.filter("k < 3")).collect()
    with pytest.raises(ValueError):
        made.transform(other, unseen="?")


def test_index_table_of_many_values_is_not_broadcast(spark, monkeypatch):
    frame = spark.range(2000).select((F.col("id") % 700).alias("v"), F.lit("x").alias("index"))
    made = features.index_table(frame, "v")
    small = plan(made.transform(frame))
    assert "BroadcastHashJoin" in small
    monkeypatch.setattr(features, "SMALL_INDEX", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = made.transform(frame, "number")
    assert "SortMergeJoin" in plan(large)
    got = {r.v: r.number for r in large.collect()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    order = sorted(range(700), key=lambda v: (-len(range(v, 2000, 700)), v))
    assert got == {v: float(i) for i, v in enumerate(order)}
    empty = features.index_table(frame.limit(0), "v")
    assert empty.size == 0 and empty.transform(frame.limit(0)).collect() == []
