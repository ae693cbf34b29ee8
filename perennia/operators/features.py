"""Feature pipeline: casts, label, indexed and one-hot nominal columns, one scaled vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions import field, safe_cast
from perennia.operators.ranking import rank_in_group
from perennia.sources.scratch import stored

#: Bytes of an index table, its values as text, up to which it is broadcast.
SMALL_INDEX = 8 << 20


class LabelMaker(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The label column as a double under its training name; the original goes."""

    source = Param(Params._dummy(), "source", "column holding the label", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "name of the label column to make", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, source: str | None = None, target: str = "target"):
        super().__init__()
        self._setDefault(target="target")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source, target = self.getOrDefault("source"), self.getOrDefault("target")
        if source not in dataset.columns:  # rows to score need no label
            return dataset
        made = dataset.withColumn(
            target, safe_cast(field(source), dataset.schema[source].dataType, T.DoubleType())
        )
        return made if source == target else made.drop(source)


class TypeCaster(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The listed columns as doubles, in one projection."""

    columns = Param(Params._dummy(), "columns", "columns to cast", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(
            {
                c: safe_cast(field(c), dataset.schema[c].dataType, T.DoubleType())
                for c in self.getOrDefault("columns")
            }
        )


class ColumnDropper(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The table without the listed columns."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault("columns"))


def string_indexer(cols: Sequence[str], unseen: str = "error") -> StringIndexer:
    """Index by falling frequency, equal counts by value.

    The distinct values of a column are kept on the driver: for nominal columns with a
    limited number of labels, not for keys.
    """
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}_index" for c in cols], handleInvalid=unseen)


@dataclass
class IndexTable:
    """The index of each value of a column, as a table ``value, index``: for keys of any number of values."""

    column: str
    table: DataFrame
    size: int
    bytes: int

    def transform(self, df: DataFrame, name: str | None = None, unseen: str = "error") -> DataFrame:
        """Adds the index (a double, as ``string_indexer`` gives).

        ``unseen`` is for null and for values that were not there when the table was made: ``error``, ``keep`` (the
        number of known values) or ``skip`` (the row goes).  The table is broadcast only where it is known to be small;
        otherwise both sides are shuffled, and a value that many rows share is split by AQE.
        """
        if unseen not in ("error", "keep", "skip"):
            raise ValueError(f"unknown rule {unseen!r} for unseen values")
        name, own = name or f"{self.column}_index", self.table.toDF("_value", "_index")
        own = F.broadcast(own) if self.bytes <= SMALL_INDEX else own
        joined = df.join(own, field(self.column) == F.col("_value"), "inner" if unseen == "skip" else "left")
        index = F.col("_index")
        if unseen == "keep":
            index = F.coalesce(index, F.lit(float(self.size)))
        elif unseen == "error":
            said = F.concat(F.lit(f"a value of {self.column} has no index: "), F.coalesce(field(self.column).cast("string"), F.lit("null")))
            index = F.when(index.isNull(), F.raise_error(said).cast("double")).otherwise(index)
        return joined.select(*[field(c) for c in df.columns if c != name], index.alias(name))


def index_table(df: DataFrame, column: str) -> IndexTable:
    """Values by falling frequency, equal counts by value, numbered from 0; null has no number.

    The values are counted in the tasks, ranked in slices and kept as a table; none of them reaches the driver.
    """
    counts = df.filter(field(column).isNotNull()).groupBy(field(column).alias("_value")).agg(F.count("*").alias("_n"))
    ranked = stored(rank_in_group(counts, [], "_n", ["_value"], name="_rank"))
    table = ranked.select(F.col("_value").alias("value"), (F.col("_rank") - 1).cast("double").alias("index"))
    sizes = ranked.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col("_value").cast("string")) + 8).alias("bytes")).first()
    return IndexTable(column, table, sizes["n"], sizes["bytes"] or 0)


def one_hot_encoder(cols: Sequence[str]) -> OneHotEncoder:
    """One slot per index but the last."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in cols], outputCols=[f"{c}_encoded" for c in cols])


def feature_pipeline(
    continuous: Sequence[str],
    nominal: Sequence[str] = (),
    label: str | None = None,
    *,
    target: str = "target",
    with_mean: bool = False,
    unseen: str = "error",
    nulls: str = "error",
    keep_inputs: bool = False,
) -> Pipeline:
    """Unfitted pipeline from raw columns to ``features`` (and ``target``).

    Continuous columns come first in the vector, then the one-hot blocks.  Every slot
    is divided by its sample standard deviation; ``with_mean`` centres it first.
    ``unseen`` says what happens to a nominal value that was not in the fitted rows
    (``error``, ``keep`` as an index of its own, ``skip``), ``nulls`` what happens to a
    row with a null feature (``error``, ``skip``).
    Columns that are no input pass through, for instance row keys.
    """
    continuous, nominal = list(continuous), list(nominal)
    encoded = [f"{c}_encoded" for c in nominal]
    stages: list[object] = [TypeCaster(columns=continuous)]
    if nominal:
        stages += [string_indexer(nominal, unseen), one_hot_encoder(nominal)]
    stages += [
        VectorAssembler(inputCols=continuous + encoded, outputCol="vectorized_features", handleInvalid=nulls),
        StandardScaler(inputCol="vectorized_features", outputCol="features", withMean=with_mean),
    ]
    if label:
        stages.append(LabelMaker(source=label, target=target))
    working = [f"{c}_index" for c in nominal] + encoded + ["vectorized_features"]
    stages.append(ColumnDropper(columns=working if keep_inputs else continuous + nominal + working))
    return Pipeline(stages=stages)


def features_to_array(df: DataFrame, name: str = "features", dtype: str = "float64") -> DataFrame:
    """The vector column as a plain array, without leaving the executors."""
    return df.withColumn(name, vector_to_array(F.col(name), dtype))
