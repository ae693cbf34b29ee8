"""Column types of text files, found in one pass, so that all files of a folder share one schema.

Every value belongs to the narrowest class that holds it; the classes that occur are bits, which an aggregate joins
within tasks, files and the folder.  What a set of classes has in common is read off a small lattice: whole numbers
widen to long and double, dates to timestamps, and whatever has nothing in common is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennia.functions.casts import text_to_double
from perennia.functions.columns import field

#: Bits of the classes.
INT, LONG, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(7))
#: Sets of classes, narrowest first, with the type that holds them; any other set is text.
LATTICE: tuple[tuple[int, str], ...] = (
    (INT, "int"),
    (INT | LONG, "bigint"),
    (INT | LONG | DOUBLE, "double"),
    (DATE, "date"),
    (DATE | TIMESTAMP, "timestamp"),
    (BOOLEAN, "boolean"),
)


def value_class(text: Column, missing: Sequence[str] = ()) -> Column:
    """The bit of a value's class; 0 for null, an empty text and the texts that stand for a missing value."""
    whole, absent = text.rlike(r"^[+-]?[0-9]+$"), text.isNull() | (text == "")
    if missing:
        absent = absent | text.isin(*missing)
    dated = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    timed = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}")
    return (
        F.when(absent, 0)
        # texts of more digits than a long has are not tried
        .when(whole & (F.length(text) < 20) & text.try_cast("int").isNotNull(), INT)
        .when(whole & (F.length(text) < 20) & text.try_cast("bigint").isNotNull(), LONG)
        .when(~dated & text_to_double(text).isNotNull(), DOUBLE)
        .when(dated & text.try_cast("date").isNotNull(), DATE)
        .when(timed & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of(bits: Column) -> Column:
    """The name of the narrowest type that holds the classes; text where there are no values."""
    chain = F.when(bits == 0, "string")
    for own, name in LATTICE:
        chain = chain.when(bits.bitwiseAND(F.lit(~own)) == 0, name)
    return chain.otherwise("string")


def column_types(rows: DataFrame, cols: Sequence[str], by: Sequence[str] = (), missing: Sequence[str] = ()) -> DataFrame:
    """by, column_name, bits, type: the classes of each text column, in groups of rows (a file, say), in one pass."""
    bits = [F.bit_or(value_class(field(c), missing)).alias(f"_b{k}") for k, c in enumerate(cols)]
    found = rows.groupBy(*[field(b) for b in by]).agg(*bits)
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(f"_b{k}"), F.lit(0)).alias("bits")) for k, c in enumerate(cols)])
    found = found.select(*[field(b) for b in by], F.inline(each))
    return found.withColumn("type", type_of(F.col("bits")))


def joined_types(found: DataFrame) -> DataFrame:
    """column_name, type over all groups: what every one of them fits into."""
    return found.groupBy("column_name").agg(F.bit_or("bits").alias("bits")).withColumn("type", type_of(F.col("bits"))).drop("bits")


def inferred_schema(found: DataFrame, names: Sequence[str]) -> T.StructType:
    """The schema of the columns ``names``, in that order; a row a column reaches the driver."""
    types = {r["column_name"]: r["type"] for r in joined_types(found).collect()}
    ddl = {"string": T.StringType()} | {t: T.StructType.fromDDL(f"x {t}")[0].dataType for _, t in LATTICE}
    return T.StructType([T.StructField(c, ddl[types.get(c, "string")]) for c in names])


def text_files(spark: SparkSession, files: Sequence[str], header: Sequence[str], **options: object) -> DataFrame:
    """Files of one header, all columns as text, and ``_file``, where a row comes from."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.csv(list(files), schema=schema, header=True, enforceSchema=False, **options)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"))
