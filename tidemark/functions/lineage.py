"""Tables kept between the rounds of iterative operators, so that a lost executor costs one round."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the folder that `spark.checkpoint.dir` names.

    Without one, only a session whose driver and executors are one process gets a temporary folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)
