"""Settings for sessions of our own (main.py, bench.py, tests); another session may take them over."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: the JVM's compiler leaves methods of more bytes alone: plans that would make one are run operator by operator, in smaller methods
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.session.timeZone": "UTC"}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    return builder
