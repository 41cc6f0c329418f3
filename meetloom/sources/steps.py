"""Steps of iterated jobs, written where all executors can read them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def stepped(df: DataFrame) -> DataFrame:
    """df computed once into the folder that the cluster names in spark.checkpoint.dir; lineage ends there, so plans don't grow with the rounds and a
    lost executor costs none of the earlier ones. Where none is named and all runs on one machine (tests), a folder of our own."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="meetloom-steps-"))
    return df.checkpoint(eager=True)
