"""One place for the session settings the operators are written against."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(app_name: str = "perennia", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time, AQE with skew handling, Arrow transfer and no web page.

    Generated methods above 8000 bytes are never compiled to machine code by the JVM, and
    a projection over some thirty columns gets there; with the lower limit such a stage
    runs in smaller methods instead, several times faster.

    ANSI mode stays on: the operators never rely on lenient casts.  The master and
    anything about executors come from the submit command unless given here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as ``--py-files`` would.

    Spark copies the archive from the driver to every executor.
    """
    context = spark.sparkContext
    if getattr(context, "_perennia_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="perennia-")) / "perennia.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._perennia_shipped = True
