"""Session helpers: tables of a data folder, and a shared place to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors cost a re-read and not a re-run.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is absent a temporary folder is set,
    but only if this machine runs all tasks, as in tests; a cluster without the setting is an error.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="cuefold-"))
    return df.checkpoint()


def to_ms(seconds) -> F.Column:
    """Seconds as whole milliseconds; null and NaN give null."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.when(~F.isnan(col), F.round(col * 1000).cast("long"))
