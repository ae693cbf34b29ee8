from __future__ import annotations

import pytest
from helpers import plan, rows, unordered
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.sources import files, inference, jdbc, schema, sinks
from perennia.sources.scratch import scratch_path


def test_snapshot_files_carry_year_and_gender(spark, tmp_path):
    (tmp_path / "players_15.csv").write_text("id,name\n1,a\n2,b\n3,NA\n")
    (tmp_path / "female_players_16.csv").write_text("id,name\n4,d\n")
    (tmp_path / "notes.txt").write_text("no snapshot")
    read = files.read_snapshots(spark, f"{tmp_path}/*.csv", "id int, name string")
    assert unordered(read) == [(1, "a", 2015, "M"), (2, "b", 2015, "M"), (3, "NA", 2015, "M"), (4, "d", 2016, "F")]


def test_snapshot_directories_of_parts(spark, tmp_path):
    for name, low in (("players_21.csv", 0), ("female_players_22", 50)):
        spark.range(low, low + 50, 1, 3).write.option("header", True).csv(f"{tmp_path}/{name}")
    read = files.read_snapshots(spark, f"{tmp_path}/*players_*", "id bigint")
    assert unordered(read.groupBy("year", "gender").count()) == [(2021, "M", 50), (2022, "F", 50)]


def test_partition_directories_name_the_snapshot(spark, tmp_path):
    frame = spark.range(100).withColumn("snapshot", F.when(F.col("id") < 30, "female_x_07").otherwise("x_19"))
    sinks.write_csv(frame, f"{tmp_path}/out", ["snapshot"])
    read = files.read_snapshots(spark, f"{tmp_path}/out/snapshot=*", "id bigint")
    assert unordered(read.groupBy("year", "gender").count()) == [(2007, "F", 30), (2019, "M", 70)]


def test_headers_are_checked_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, f"{tmp_path}/x.csv", "a int, b int").collect()


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n2,y\n")
    assert files.read_csv(spark, f"{tmp_path}/x.csv").dtypes == [("a", "int"), ("b", "string")]


def test_csv_roundtrip_keeps_values(spark, tmp_path):
    frame = spark.createDataFrame(
        [(1, "plain", 0.1), (2, 'with "quotes", commas', -1.5e300), (3, None, None), (4, "NA", 2.0)],
        "id int, s string, d double",
    )
    sinks.write_csv(frame, f"{tmp_path}/out")
    assert unordered(files.read_csv(spark, f"{tmp_path}/out", frame.schema)) == unordered(frame)


def test_union_by_name_and_position(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, id int")
    c = spark.createDataFrame([(3,)], "id int")
    assert unordered(files.union_all([a, b, c])) == [(1, "x"), (2, "y"), (3, None)]
    assert unordered(files.union_all([a, a], by_name=False)) == [(1, "x"), (1, "x")]
    with pytest.raises(ValueError):
        files.union_all([])


def test_snapshots_by_period_are_pruned(spark, tmp_path):
    frame = spark.range(60).select("id", (F.col("id") % 3 + 2015).cast("int").alias("year"), F.lit("M").alias("gender"))
    sinks.write_snapshots(frame, f"{tmp_path}/p")
    one = spark.read.parquet(f"{tmp_path}/p").filter("year = 2016")
    assert one.count() == 20
    assert "PartitionFilters: [isnotnull(year" in plan(one)


def test_conform_casts_fills_and_reports(spark):
    frame = spark.createDataFrame(
        [("1", "2020-01-31", "NA", "drop"), ("2.0", "31.01.2020", "3.5", "drop"), ("x", None, "7", "drop")],
        "i string, d string, v string, extra string",
    )
    target = T.StructType.fromDDL("i int, d date, v double, absent string")
    conformed = schema.conform(frame, target)
    assert conformed.dtypes == [("i", "int"), ("d", "date"), ("v", "double"), ("absent", "string")]
    as_text = conformed.withColumn("d", F.col("d").cast("string"))
    assert rows(as_text) == [(1, "2020-01-31", None, None), (2, None, 3.5, None), (None, None, 7.0, None)]
    assert dict(rows(schema.conform_losses(frame, target))) == {"i": 1, "d": 1, "v": 0}


def test_player_schema_types():
    kinds = [f.dataType.simpleString() for f in schema.player_schema()]
    assert len(kinds) == 112
    assert {k: kinds.count(k) for k in set(kinds)} == {"int": 55, "string": 51, "double": 4, "date": 2}
    assert len(schema.player_file_schema()) == 110


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "t", {"user": "u"})
    assert plain["dbtable"] == "t" and plain["user"] == "u" and "partitionColumn" not in plain
    split = jdbc.jdbc_options("jdbc:x", "t", column="id", lower=0, upper=1000, partitions=8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "id",
        "0",
        "1000",
        "8",
    )
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", column="id", partitions=8)


def test_schema_profile_and_preview(spark):
    frame = spark.createDataFrame([(1, "NA", 1.0), (2, None, float("nan")), (3, "x", None)], "i int, s string, d double")
    profile = {r.column_name: (r.missing, r.data_type, r.position) for r in sinks.schema_profile(frame, counts=True).collect()}
    assert profile == {"i": (0, "int", 1), "s": (2, "string", 2), "d": (2, "double", 3)}
    plain = sinks.schema_profile(frame)
    assert [tuple(r) for r in plain.collect()][0] == ("i", "int", True, 1) and "missing" not in plain.columns
    top = sinks.preview(frame, [F.desc("i")], 2)
    assert [r.i for r in top.collect()] == [3, 2]
    assert "TakeOrderedAndProject" in plan(top)


def test_scratch_paths_are_new_and_in_the_named_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert a.startswith(named.rstrip("/"))


def test_snapshots_by_name_and_csv_only(spark, tmp_path):
    (tmp_path / "players_15.csv").write_text("id,name,age\n1,a,20\n2,b,21\n")
    (tmp_path / "female_players_16.csv").write_text("age,id,extra\n30,3,x\n")
    (tmp_path / "readme.md").write_text("some text, and more\n")
    (tmp_path / "notes.txt").write_text("id,name\n")
    got = files.read_snapshots(spark, str(tmp_path), "id int, name string, age int")
    assert got.columns == ["id", "name", "age", "year", "gender"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", 20, 2015, "M"), (2, "b", 21, 2015, "M"), (3, None, 30, 2016, "F")]


def test_types_are_those_of_all_files(spark, tmp_path):
    (tmp_path / "x_15.csv").write_text("id,code,size,day,flag,none\n1,5,3,2020-01-02,true,\n2,,4,2021-12-31,FALSE,\n")
    (tmp_path / "x_16.csv").write_text("code,id,size,day,none\nA7,3000000000,2.5e3,2020-01-02 10:11:12,NA\n9,4,-1,2020-02-03,\n")
    found = {(r.snapshot, r.column_name): r.type for r in files.snapshot_types(spark, str(tmp_path), missing=["NA"]).collect()}
    assert found["x_15.csv", "code"] == "int" and found["x_16.csv", "code"] == "string"
    assert found["x_15.csv", "day"] == "date" and found["x_16.csv", "day"] == "timestamp"
    inferred = files.infer_schema(spark, str(tmp_path), missing=["NA"])
    assert {f.name: f.dataType.simpleString() for f in inferred} == {
        "id": "bigint", "code": "string", "size": "double", "day": "timestamp", "flag": "boolean", "none": "string",
    }
    read = files.read_snapshots(spark, str(tmp_path), inferred.add("extra", "integer"))
    assert unordered(read.select("id", "code", "size", "flag", "extra", "year")) == [
        (1, "5", 3.0, True, None, 2015), (2, None, 4.0, False, None, 2015),
        (3000000000, "A7", 2500.0, None, None, 2016), (4, "9", -1.0, None, None, 2016),
    ]
    assert files.read_snapshots(spark, str(tmp_path)).columns[-2:] == ["year", "gender"]


def test_classes_of_values(spark):
    values = {
        "7": "int", "-2147483648": "int", "2147483648": "bigint", "+5": "int", "9" * 30: "double", "1.5": "double",
        "-.5e3": "double", "NaN": "double", "2020-02-29": "date", "2021-02-29": "string", "2020-01-01T00:00": "timestamp",
        "True": "boolean", "x": "string", "1_000": "string", "2020-1-1": "string", "": "string", None: "string",
    }
    frame = spark.createDataFrame(list(values.items()), "v string, want string")
    got = frame.select("v", "want", inference.type_of(inference.value_class(F.col("v"))).alias("got")).collect()
    assert [r for r in got if r.got != r.want] == []


def test_types_of_nothing(spark, tmp_path):
    assert files.snapshot_types(spark, str(tmp_path)).collect() == []
    (tmp_path / "e_15.csv").write_text("a,b\n")
    assert files.infer_schema(spark, str(tmp_path)).simpleString() == "struct<a:string,b:string>"
