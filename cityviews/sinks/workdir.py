"""Work folders that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder path under ``spark.checkpoint.dir``.

    Without that setting it lies under the warehouse folder, which every Spark deployment
    shares among driver and executors. The rule is the same for every master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{shared.rstrip('/')}/cityviews/{name}-{uuid.uuid4().hex}"
