"""What the operators of this folder need of a session."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from specloom.session import ship_package

# Rows of an Arrow batch: texts are long, and the default of 10,000 rows holds tens of MB on both sides.
BATCH_ROWS = 2_000
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> SparkSession:
    """Send the package to the workers, and keep Arrow batches of texts small unless the session says otherwise."""
    ship_package(spark)
    if spark.conf.get(SETTING, "10000") == "10000":
        spark.conf.set(SETTING, str(BATCH_ROWS))
    return spark


def quoted(name: str) -> Column:
    """The column of just this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
