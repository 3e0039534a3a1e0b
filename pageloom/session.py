"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "pageloom", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if "spark.checkpoint.dir" not in conf:
        # one machine, so any folder of it is shared; a cluster sets its own
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pageloom-"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    Executors and driver read and write it, so it is the folder the cluster names. Where
    the setting is absent there is no folder that all of them see, and this is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for results that are read several times.

    It is computed once, and a lost executor costs no more than reading it again.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
