"""Tables that a job writes for its own use, in the folder that the driver and all executors share."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or that of setCheckpointDir. Only a session of one machine gets a temporary one where both are unset."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lociq-"))
        place = spark.sparkContext.getCheckpointDir()
    return place


def stored(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it: lineage ends here, and its size is known to the planner."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
