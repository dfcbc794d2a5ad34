"""Places for the tables a query writes on its way."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def new_place(spark: SparkSession, name: str) -> str:
    """A fresh directory path in the shared folder of the cluster.

    Only a local session without such a folder gets a temporary one on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerlake-")
    return f"{shared.rstrip('/')}/ledgerlake/{name}-{uuid4().hex}"
