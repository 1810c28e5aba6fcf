"""Session, table access and lineage helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A dimension is broadcast only after a count shows that it has no more rows than this.
BROADCAST_ROWS = 20_000


def make_session(app: str = "gleanery", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``master`` only for local use."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where that setting is absent and the session is local (tests) a temporary folder of this machine
    is set once and removed at the end; on a cluster the setting must be there.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"gleanery-{uuid.uuid4().hex}")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a compressed table of which each reader reads the columns it needs."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count proves it small, else ``df`` as it is (shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
