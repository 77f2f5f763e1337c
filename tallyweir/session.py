"""Session settings that the plans of this package want."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles a method over 8,000 bytes of bytecode.  With Spark's default of
# 65,535 a long projection is fused into one larger method and runs interpreted, several
# times slower; with this limit its operators run one by one, each compiled.
JIT_METHOD_LIMIT = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Set what is safe to set on a running session; cluster sizing is left to the cluster."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    return spark
