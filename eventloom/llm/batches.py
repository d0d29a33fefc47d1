"""Size of the Arrow batches between the JVM and Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows a batch where rows hold whole texts; Spark's 10,000 take 35 MB a batch on either side of every task.
RECORDS = 2000


def lean_batches(spark: SparkSession) -> None:
    """Lower the session's rows a batch to ``RECORDS``; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > RECORDS:
        spark.conf.set(name, str(RECORDS))
