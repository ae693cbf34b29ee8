"""Registered queries: every operator over the whole of a given table.

The tables hold no missing values, so columns with gaps, markers and rating texts are
derived from the rows inside the query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions import year_at_most
from perennia.operators import analytics, clean, features, mlp, models, outliers, quality, quantiles, ranking
from perennia.operators import split, stats
from perennia.session import ship_package
from perennia.sources import files, inference, schema, sinks
from perennia.sources.scratch import scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(column: Column | str, digits: int = 6) -> Column:
    # Adding zero turns -0.0 into 0.0.
    return F.round(column, digits) + F.lit(0.0)


# --- derived inputs -----------------------------------------------------------------


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with nulls, NaN, the text NA, a column 60 % NA and one half null."""
    event_id = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.when(event_id % 3 != 0, F.col("value")).alias("value_gap"),
        F.when(event_id % 4 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value_nan"),
        F.when(F.col("event_type") == "error", "NA").otherwise(F.col("event_type")).alias("type_na"),
        F.when(event_id % 5 < 3, "NA").otherwise(F.col("event_type")).alias("mostly_na"),
        F.when(event_id % 2 == 0, F.col("user_id")).alias("half_null"),
    )


def rating_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with texts such as 23+6, 17-2, 40 and NA."""
    base, change = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string")
    kind = F.col("l_linenumber") % 4
    text = (
        F.when(kind == 0, "NA")
        .when(kind == 1, F.concat(base, F.lit("+"), change))
        .when(kind == 2, F.concat(base, F.lit("-"), change))
        .otherwise(base)
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("rating"))


def measured_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric event columns, one with nulls and one with two values only."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "value",
        F.when(F.col("event_id") % 3 != 0, value * value).alias("energy"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_error"),
    )


MEASURES = ["user_id", "value", "energy", "is_error"]


def charges(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Lineitem with a label that follows from other columns, split by order.

    ``spread`` deals the rows to several files a core: a file of few row groups is read by as few tasks.
    """
    price = F.col("l_extendedprice") / 1000
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        price.alias("price"),
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("charge"),
    )
    # models pass over the rows many times: they are read, computed and split once
    labelled = split.split_labels(rows, ["l_orderkey"], (0.8, 0.2), 66)
    return stored(labelled.repartition(max(16, 4 * spark.sparkContext.defaultParallelism)) if spread else labelled)


CONTINUOUS = ["l_quantity", "price", "l_discount", "l_tax"]
NOMINAL = ["l_returnflag", "l_linestatus"]


def prepared_charges(spark: SparkSession, sf_dir: str, with_mean: bool = False, spread: bool = False) -> DataFrame:
    rows = charges(spark, sf_dir, spread)
    pipeline = features.feature_pipeline(CONTINUOUS, NOMINAL, "charge", with_mean=with_mean)
    return pipeline.fit(rows.filter("split = 'train'")).transform(rows)


def price_pipeline(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """charge ~ price, fitted on the train part."""
    train = charges(spark, sf_dir).filter("split = 'train'")
    return Pipeline(
        stages=[
            features.LabelMaker(source="charge", target="target"),
            VectorAssembler(inputCols=["price"], outputCol="features"),
            models.LinearRegression(featuresCol="features", labelCol="target", maxIter=100),
        ]
    ).fit(train)


# --- filters, groups, ranks -----------------------------------------------------------


@query
def filter_equality(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query
def filter_range(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    rows = lineitem.filter(year_at_most(lineitem, "l_shipdate", 1997) & (F.col("l_quantity") >= 10))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def group_count(spark, sf_dir):
    return analytics.group_count(table(spark, sf_dir, "events"), "event_type")


@query
def group_count_2key(spark, sf_dir):
    return analytics.group_count(
        table(spark, sf_dir, "orders"), F.year("o_orderdate").alias("year"), "o_orderpriority"
    )


@query
def group_avg(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    sizes = analytics.group_avg(part, ["p_brand"], "p_size", "avg_size")
    return sizes.select("p_brand", rounded("avg_size").alias("avg_size"))


@query
def group_avg_floating(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    prices = analytics.group_avg(lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", "avg_price")
    return prices.select("l_returnflag", "l_linestatus", rounded("avg_price", 4).alias("avg_price"))


@query
def topk(spark, sf_dir):
    counts = analytics.group_count(table(spark, sf_dir, "part"), "p_brand")
    return ranking.top_k(counts, 5, "n", ["p_brand"])


@query
def topk_with_ties(spark, sf_dir):
    counts = analytics.group_count(table(spark, sf_dir, "orders"), "o_custkey")
    return ranking.top_k(counts, 5, "n", ["o_custkey"], ties="keep")


@query
def bottomk_with_ties(spark, sf_dir):
    counts = analytics.group_count(table(spark, sf_dir, "orders"), "o_custkey")
    return ranking.top_k(counts, 5, "n", ["o_custkey"], descending=False, ties="keep")


@query
def extreme_avg_groups(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter(F.col("p_type") == "ECONOMY")
    top = analytics.extreme_groups_by_avg(part, 5, group="p_brand", measure="p_size", name="avg_size")
    return top.withColumn("avg_size", rounded("avg_size"))


@query
def extreme_avg_groups_lowest(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter(F.col("p_type") == "ECONOMY")
    top = analytics.extreme_groups_by_avg(part, -5, group="p_brand", measure="p_size", name="avg_size")
    return top.withColumn("avg_size", rounded("avg_size"))


@query
def extreme_avg_groups_floating(spark, sf_dir):
    """A measure with tiny values, and with infinite ones in some groups; a group per supplier."""
    tiny = F.col("l_quantity") * F.lit(2.0**-40)
    measure = F.when(F.col("l_suppkey") % 50 == 7, float("inf")).otherwise(tiny)
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", measure.alias("measure"))
    top = analytics.extreme_groups_by_avg(rows, 1, group="l_suppkey", measure="measure", name="avg_measure")
    low = analytics.extreme_groups_by_avg(rows, -3, group="l_suppkey", measure="measure", name="avg_measure")
    return files.union_all([top.withColumn("highest", F.lit(True)), low.withColumn("highest", F.lit(False))])


@query
def dedup_latest(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    latest = analytics.dedup_latest(lineitem, ["l_partkey"], "l_shipdate")
    return latest.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def _contracts(spark, sf_dir, ties):
    return analytics.top_groups_by_contract(
        table(spark, sf_dir, "lineitem"),
        1997,
        5,
        10,
        entity=["l_partkey", "l_linenumber"],
        group="l_suppkey",
        joined="l_shipdate",
        until="l_quantity",
        period="l_shipdate",
        ties=ties,
    )


@query
def contract_top_groups(spark, sf_dir):
    return _contracts(spark, sf_dir, "cut")


@query
def contract_top_groups_ties(spark, sf_dir):
    return _contracts(spark, sf_dir, "keep")


def _dated_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))


@query
def rank_in_group(spark, sf_dir):
    return analytics.rank_values_in_group(_dated_orders(spark, sf_dir), "o_orderpriority", "o_custkey")


@query
def mode_per_group(spark, sf_dir):
    return analytics.mode_per_group(_dated_orders(spark, sf_dir), "year", "o_orderpriority")


@query
def mode_per_group_ties(spark, sf_dir):
    return analytics.mode_per_group(_dated_orders(spark, sf_dir), "year", "o_custkey", ties="keep")


@query
def topk_per_group(spark, sf_dir):
    return analytics.top_values_per_group(_dated_orders(spark, sf_dir), "year", "o_custkey", 5)


# --- sources and sinks ------------------------------------------------------------------


@query
def union_all(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    finished = orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderpriority")
    others = orders.filter(F.col("o_orderstatus") != "F").select("o_custkey", "o_orderkey")
    return files.union_all([finished, others])


@query
def multi_file_scan(spark, sf_dir):
    year = F.year("o_orderdate")
    prefix = F.when(F.col("o_orderstatus") == "F", "female_").otherwise("")
    name = F.concat(prefix, F.lit("orders_"), F.lpad((year % 100).cast("string"), 2, "0"))
    kept = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    folder = scratch_path(spark, "snapshots")
    straight = table(spark, sf_dir, "orders").filter(year != 1996).select(*kept, name.alias("snapshot"))
    sinks.write_csv(straight, folder, ["snapshot"])
    # beside them, a text that is no snapshot; snapshots of some years have their columns in another order
    table(spark, sf_dir, "region").select("r_name").write.mode("append").text(f"{folder}/snapshot=orders_95")
    turned = table(spark, sf_dir, "orders").filter(year == 1996).select(*kept[::-1], name.alias("snapshot"))
    sinks.write_csv(turned, f"{folder}-turned", ["snapshot"])
    ddl = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
    return files.read_snapshots(spark, [f"{folder}/snapshot=*", f"{folder}-turned/snapshot=*"], ddl)


@query
def inferred_types(spark, sf_dir):
    """Files a year, in some of which columns are wider or text: the type of each column in each file and in all."""
    year, day = F.year("o_orderdate"), F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf_dir, "orders").select(
        F.when(year == 1995, F.col("o_orderkey") * 10**9).otherwise(F.col("o_orderkey")).alias("key"),
        F.when(year == 1996, F.concat(F.lit("x"), "o_custkey")).otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(year == 1993, F.floor("o_totalprice").cast("string")).otherwise(F.col("o_totalprice").cast("decimal(20,2)").cast("string")).alias("price"),
        F.when(year == 1994, F.concat(day, F.lit(" 10:00:00"))).otherwise(day).alias("day"),
        F.concat(F.lit("orders_"), F.lpad((year % 100).cast("string"), 2, "0")).alias("snapshot"),
    )
    folder = scratch_path(spark, "snapshots")
    sinks.write_csv(orders, folder, ["snapshot"])
    found = stored(files.snapshot_types(spark, f"{folder}/snapshot=*"))
    whole = inference.joined_types(found).select(F.lit("all").alias("snapshot"), "column_name", "type")
    return found.select("snapshot", "column_name", "type").unionByName(whole)


@query
def csv_roundtrip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    folder = scratch_path(spark, "orders")
    sinks.write_csv(orders, folder)
    return files.read_csv(spark, folder, orders.schema).withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )


TARGET_SCHEMA = "l_orderkey bigint, rating int, amount double, l_shipdate date, comment string"


def _texts(spark, sf_dir):
    """Lineitem as untyped text: numbers, rating texts and markers."""
    lineitem = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(quantity, F.lit("+3"))).otherwise(quantity).alias("rating"),
        F.when(F.col("l_linenumber") % 5 == 0, "NA")
        .otherwise(F.col("l_extendedprice").cast("decimal(20,2)").cast("string"))
        .alias("amount"),
        F.when(F.col("l_linenumber") % 4 == 0, "unknown")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("l_shipdate"),
    )


@query
def conform_schema(spark, sf_dir):
    conformed = schema.conform(_texts(spark, sf_dir), T.StructType.fromDDL(TARGET_SCHEMA))
    return conformed.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query
def conform_losses(spark, sf_dir):
    return schema.conform_losses(_texts(spark, sf_dir), T.StructType.fromDDL(TARGET_SCHEMA))


@query
def safe_cast(spark, sf_dir):
    texts = _texts(spark, sf_dir).select("l_orderkey", "rating", "amount")
    return clean.cast_columns(texts, {"l_orderkey": "bigint", "rating": "int", "amount": "double"})


@query
def non_numeric_counts(spark, sf_dir):
    return quality.non_numeric_counts(_texts(spark, sf_dir))


@query
def preview_top_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sinks.preview(orders, [F.desc("o_totalprice"), "o_orderkey"], 20)


@query
def schema_profile(spark, sf_dir):
    return sinks.schema_profile(gappy_events(spark, sf_dir), counts=True)


# --- quality and cleaning ---------------------------------------------------------------


@query
def date_parts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("joined")
    )
    dated = clean.cast_columns(orders, {"joined": "date"})
    return dated.select("o_orderkey", F.date_format("joined", "yyyy-MM-dd").alias("joined"), F.year("joined").alias("year"))


@query
def missing_counts(spark, sf_dir):
    return quality.missing_counts(gappy_events(spark, sf_dir))


@query
def missing_ratio(spark, sf_dir):
    return quality.missing_ratio(gappy_events(spark, sf_dir)).withColumn("ratio", rounded("ratio"))


@query
def drop_sparse_columns(spark, sf_dir):
    return quality.drop_sparse(gappy_events(spark, sf_dir).drop("value_nan"))


@query
def select_by_type(spark, sf_dir):
    return quality.select_by_type(table(spark, sf_dir, "part"), ["int", "double"])


@query
def mean_impute(spark, sf_dir):
    events = gappy_events(spark, sf_dir).select("event_id", "value_gap", "value_nan")
    filled = clean.impute_mean(events, ["value_gap", "value_nan"])
    return filled.select(
        "event_id", rounded("value_gap").alias("value_gap"), rounded("value_nan").alias("value_nan")
    )


@query
def parse_rating(spark, sf_dir):
    return clean.parse_ratings(rating_texts(spark, sf_dir), ["rating"])


@query
def parse_rating_sum(spark, sf_dir):
    return clean.parse_ratings(rating_texts(spark, sf_dir), ["rating"], mode="sum")


@query
def encode_binary(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return clean.encode_columns(lineitem, {"l_linestatus": {"O": 1, "F": 0}, "l_returnflag": {"R": 1, "A": 0}})


# --- outliers and statistics ------------------------------------------------------------


@query
def quantiles_(spark, sf_dir):
    return quantiles.quantiles(measured_events(spark, sf_dir), MEASURES).withColumn("value", rounded("value"))


@query
def outlier_bounds(spark, sf_dir):
    bounds = outliers.outlier_bounds(measured_events(spark, sf_dir), MEASURES)
    return bounds.select(
        "column_name",
        "n",
        *[rounded(c).alias(c) for c in ("minimum", "q1", "q3", "maximum", "lower_bound", "upper_bound")],
        "two_valued",
    )


def _counted(spark, sf_dir):
    events = measured_events(spark, sf_dir)
    return outliers.outlier_count(events, outliers.outlier_bounds(events, MEASURES))


@query
def outlier_count(spark, sf_dir):
    return _counted(spark, sf_dir).select("event_id", "total_outliers")


@query
def outlier_count_ints(spark, sf_dir):
    """Only int columns, two-valued ones included."""
    events = measured_events(spark, sf_dir).withColumn("whole", F.floor("value").cast("int"))
    cols = outliers.outlier_columns(events, ints_only=True)
    counted = outliers.outlier_count(events, outliers.outlier_bounds(events, cols), skip_two_valued=False)
    return counted.select("event_id", "total_outliers")


@query
def outlier_filter(spark, sf_dir):
    events = measured_events(spark, sf_dir)
    kept = outliers.drop_outlier_rows(events, outliers.outlier_bounds(events, MEASURES), max_flags=1)
    return kept.select("event_id", "user_id", "value")


@query
def outlier_distribution(spark, sf_dir):
    return outliers.outlier_distribution(_counted(spark, sf_dir))


@query
def histogram(spark, sf_dir):
    bins = stats.histogram(table(spark, sf_dir, "events"), "value", 20)
    return bins.select("bin", rounded("lower").alias("lower"), rounded("upper").alias("upper"), "n")


@query
def correlation_matrix(spark, sf_dir):
    cols = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    matrix = stats.correlation_matrix(table(spark, sf_dir, "lineitem"), cols)
    return matrix.withColumn("r", rounded("r", 9))


WIDE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "quantity_gap", "l_extendedprice",
    "l_discount", "l_tax", "price_gap", "ship_year", "ship_month", "ship_day",
]


WIDE_ODD = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "even", "constant_if_even", "gap", "endless_in_gap",
]


@query
def correlation_matrix_wide(spark, sf_dir):
    """More pairs than one aggregate should hold, with gaps in two columns."""
    ship = F.col("l_shipdate")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "*",
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("quantity_gap"),
        F.when(F.col("l_linenumber") % 4 != 0, F.col("l_extendedprice") * F.col("l_tax")).alias("price_gap"),
        F.year(ship).alias("ship_year"),
        F.month(ship).alias("ship_month"),
        F.dayofmonth(ship).alias("ship_day"),
    )
    ship_package(spark)
    return stats.correlation_matrix(lineitem, WIDE).withColumn("r", rounded("r", 8))


@query
def correlation_matrix_odd(spark, sf_dir):
    """A pair that is constant on the rows it shares, and an infinity beside a gap."""
    line = F.col("l_linenumber")
    columns = {c: F.col(c) for c in WIDE_ODD[:-4]}
    columns["even"] = F.when(line % 2 == 0, F.col("l_quantity"))
    columns["constant_if_even"] = F.when(line % 2 == 0, 1e6 + 0.1).otherwise(F.col("l_extendedprice"))
    columns["gap"] = F.when(line != 3, F.col("l_discount"))
    columns["endless_in_gap"] = F.when(line == 3, float("inf")).when(line % 2 == 0, F.col("l_tax"))
    rows = table(spark, sf_dir, "lineitem").select(*[c.alias(n) for n, c in columns.items()])
    ship_package(spark)
    matrix = stats.correlation_matrix(rows, WIDE_ODD)
    odd = F.col("a").isin(WIDE_ODD[-4:]) & F.col("b").isin(WIDE_ODD[-4:])
    return matrix.filter(odd).withColumn("r", rounded("r", 8))


# --- split, features, models ---------------------------------------------------------------


@query
def hash_split(spark, sf_dir):
    train, test = split.hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"], (0.8, 0.2), 66)
    parts = [part.select("o_orderkey", F.lit(name).alias("split")) for part, name in ((train, "train"), (test, "test"))]
    return files.union_all(parts)


@query
def string_index(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    indexed = features.string_indexer(["event_type"]).fit(events).transform(events)
    return indexed.select("event_id", "event_type", "event_type_index")


@query
def string_index_table(spark, sf_dir):
    """An index over a key of many values: ranked, kept and joined as a table."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return features.index_table(lineitem, "l_partkey").transform(lineitem)


def _encoded(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    stages = [features.string_indexer(["event_type"]), features.one_hot_encoder(["event_type"])]
    return Pipeline(stages=stages).fit(events).transform(events)


@query
def one_hot(spark, sf_dir):
    slots = vector_to_array("event_type_encoded")
    return _encoded(spark, sf_dir).select("event_id", *[slots[i].alias(f"slot_{i}") for i in range(4)])


@query
def assemble_features(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = VectorAssembler(inputCols=cols, outputCol="features").transform(lineitem)
    rows = features.features_to_array(rows)
    x = F.col("features")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.size(x).alias("width"),
        *[rounded(x[i], 2).alias(f"x{i}") for i in range(len(cols))],
    )


@query
def standard_scale(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_discount", "l_tax"]
    stages = [
        VectorAssembler(inputCols=cols, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
    ]
    rows = features.features_to_array(Pipeline(stages=stages).fit(lineitem).transform(lineitem))
    x = F.col("features")
    return rows.select("l_orderkey", "l_linenumber", *[rounded(x[i]).alias(f"x{i}") for i in range(len(cols))])


@query
def feature_pipeline(spark, sf_dir):
    rows = features.features_to_array(prepared_charges(spark, sf_dir))
    x = F.col("features")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "split",
        rounded("target", 4).alias("target"),
        *[rounded(x[i], 5).alias(f"x{i}") for i in range(7)],
    )


@query
def linear_regression(spark, sf_dir):
    """charge ~ price: slope and intercept of the train part, put next to its row count."""
    model = price_pipeline(spark, sf_dir).stages[-1]
    train = charges(spark, sf_dir).filter("split = 'train'")
    return train.agg(
        F.count("*").alias("n"),
        rounded(F.lit(float(model.coefficients[0])), 8).alias("slope"),
        rounded(F.lit(float(model.intercept)), 6).alias("intercept"),
    )


@query
def score_predictions(spark, sf_dir):
    model = price_pipeline(spark, sf_dir)
    scored = models.score(model, charges(spark, sf_dir), ["l_orderkey", "l_linenumber", "split"])
    return scored.select(
        "l_orderkey",
        "l_linenumber",
        "split",
        rounded("target", 3).alias("target"),
        rounded("prediction", 3).alias("prediction"),
    )


def _metrics(scored: DataFrame) -> DataFrame:
    metrics = stats.regression_metrics(scored, by=["split"])
    return metrics.select("split", "n", *[rounded(c).alias(c) for c in ("mse", "rmse", "mae", "r2")])


@query
def regression_metrics(spark, sf_dir):
    return _metrics(models.score(price_pipeline(spark, sf_dir), charges(spark, sf_dir), ["split"]))


@query
def model_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "model")
    models.save_model(price_pipeline(spark, sf_dir), path)
    scored = models.score(models.load_model(spark, path), charges(spark, sf_dir), ["l_orderkey", "l_linenumber"])
    return scored.select("l_orderkey", "l_linenumber", rounded("prediction", 3).alias("prediction"))


@query
def linear_regression_wide(spark, sf_dir):
    """All features; mse, rmse, mae and r2 of both parts."""
    prepared = prepared_charges(spark, sf_dir)
    return _metrics(models.score(models.fit_linear(prepared.filter("split = 'train'")), prepared, ["split"]))


@query
def decision_tree(spark, sf_dir):
    prepared = prepared_charges(spark, sf_dir)
    return _metrics(models.score(models.fit_tree(prepared.filter("split = 'train'")), prepared, ["split"]))


@query
def decision_tree_cells(spark, sf_dir):
    """Features of few values, 42 cells: a tree deep enough predicts the mean of each cell's train rows."""
    cells = ["l_linenumber", "l_returnflag", "l_linestatus"]
    rows = charges(spark, sf_dir).withColumns({f"cell_{c}": F.col(c) for c in cells})
    pipeline = features.feature_pipeline(["l_linenumber"], NOMINAL, "charge")
    prepared = pipeline.fit(rows.filter("split = 'train'")).transform(rows)
    tree = models.fit_tree(prepared.filter("split = 'train'"))
    scored = models.score(tree, prepared.filter("split = 'train'"), [f"cell_{c}" for c in cells]).toDF(*cells, "target", "prediction")
    return scored.groupBy(*cells).agg(F.count("*").alias("n"), rounded(F.avg("prediction"), 6).alias("prediction"))


def _trained(spark, sf_dir, config):
    ship_package(spark)
    prepared = prepared_charges(spark, sf_dir, with_mean=True, spread=True)
    return mlp.train_mlp(prepared.filter("split = 'train'"), config), prepared


#: 100 epochs; all rows are one step, whose size asks for a larger and slower falling rate than small batches do.
HUNDRED = mlp.MLPConfig(epochs=100, batch_size=None, learning_rate=3e-3, decay=0.99)


@query
def mlp_regression(spark, sf_dir):
    """Three hidden layers of 128; metrics of both parts."""
    model, prepared = _trained(spark, sf_dir, HUNDRED)
    return _metrics(model.predict(prepared))


@query
def mlp_regression_deep(spark, sf_dir):
    """Eight hidden layers of 512, one epoch; metrics of both parts."""
    model, prepared = _trained(spark, sf_dir, mlp.MLPConfig(hidden=mlp.DEEP.hidden, epochs=1, batch_size=65_536))
    return _metrics(model.predict(prepared))


@query
def mlp_history(spark, sf_dir):
    """The epochs of a network of one hidden layer, each with its rate and steps; and whether its loss is a number."""
    model, _ = _trained(spark, sf_dir, replace(HUNDRED, hidden=(32,)))
    finite = (F.col("loss") >= 0) & (F.col("loss") < float("inf"))
    return model.history_table().select("epoch", rounded("learning_rate", 9).alias("learning_rate"), "steps", finite.alias("has_loss"))


@query
def mlp_linear(spark, sf_dir):
    """charge ~ price by a network without hidden layers: slope and intercept of the train part."""
    ship_package(spark)
    rows = charges(spark, sf_dir).filter("split = 'train'").withColumn("x", F.col("price"))
    pipeline = features.feature_pipeline(["price"], [], "charge", with_mean=True)
    prepared = pipeline.fit(rows).transform(rows)
    config = mlp.MLPConfig(hidden=(), epochs=200, batch_size=None, learning_rate=1.0, decay=0.985)
    scored = mlp.train_mlp(prepared, config).predict(prepared)
    ends = scored.agg(
        F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b"),
        F.min_by("prediction", "x").alias("ya"), F.max_by("prediction", "x").alias("yb"),
    )
    slope = (F.col("yb") - F.col("ya")) / (F.col("b") - F.col("a"))
    return ends.select("n", rounded(slope, 2).alias("slope"), rounded(F.col("ya") - slope * F.col("a"), 1).alias("intercept"))


@query
def mlp_score(spark, sf_dir):
    """Predictions of a network that was saved and read back."""
    model, prepared = _trained(spark, sf_dir, replace(HUNDRED, hidden=(32,)))
    path = scratch_path(spark, "mlp")
    model.save(path)
    scored = mlp.load_mlp(spark, path).predict(prepared)
    return scored.select("l_orderkey", "l_linenumber", "split", "target", "prediction")
