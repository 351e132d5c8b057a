"""Where written tables live."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_path(spark: SparkSession, name: str) -> str:
    """New path in the shared folder that the session names in ``spark.checkpoint.dir``, else in its warehouse.

    Both are folders that all executors share; a machine's own folders are never used.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    root = root or f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
