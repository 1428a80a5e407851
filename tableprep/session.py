"""Session and table helpers.

Nothing here tunes Spark for a specific machine: on a cluster the operator
brings its own session; ``get_session`` only fills settings that are unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "tableprep", **conf: str) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None and master is None and not conf:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder: the cluster's ``spark.checkpoint.dir`` when set.

    Only when nothing is configured (local tests) a scratch folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder; a machine-local folder "
            "does not survive executor loss on a cluster")
    path = tempfile.mkdtemp(prefix="tableprep-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table ``name``: the plain scan, whatever its size."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
