"""Session settings and the shared folder used for stored stages and stream ledgers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on. Join strategies are left to adaptive execution, which measures shuffle sizes
#: before it broadcasts (see :func:`broadcast_what_is_measured`) and splits skewed partitions of sort-merge joins even if that costs a further shuffle.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

_ESTIMATED, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: Bytes up to which a join side may be broadcast by its estimate alone, and by its measured size.
MOST_ESTIMATED, MOST_MEASURED = 256 << 10, 2 << 20


def broadcast_what_is_measured(spark: SparkSession) -> None:
    """Lower the session's limit for broadcasts, that for estimates more than that for measured sizes.

    A scan is estimated by the bytes of its packed columns and an exploded array counts as one element, so a table of a few
    megabytes can be hundreds in the driver's memory; the hash table of measured rows takes some five times their bytes.
    Limits that are lower already stay.
    """
    size, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", spark.conf.get(_ESTIMATED).strip().lower()).groups()
    limit = int(size) << 10 * " kmgt".index(unit or " ")
    if limit > MOST_ESTIMATED:
        if spark.conf.get(_MEASURED, None) is None:
            spark.conf.set(_MEASURED, str(min(limit, MOST_MEASURED)))
        spark.conf.set(_ESTIMATED, str(MOST_ESTIMATED))


def build_session(app_name: str = "stockloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`ENGINE_CONF`; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    broadcast_what_is_measured(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stockloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name of the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Store a stage that feeds several outputs as a table in the shared folder and go on from there.

    The lineage ends at files that survive lost executors, readers scan only the columns they need, and join planning
    knows the real size. Files are packed with zstd, as stages are written once and read a few times. The table stays until
    the folder is cleaned.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
