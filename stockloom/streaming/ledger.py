"""A keyed ledger of accepted rows, one folder per micro-batch, so a replayed batch changes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType


class Ledger:
    """Rows accepted by a stream, stored as ``<folder>/batch=<id>``.

    With a ``horizon`` a batch looks back that many batches only, so its work does not grow with the age of the stream; a copy
    that comes later than that counts as new. Without one all batches are compared.
    """

    def __init__(self, folder: str, schema: StructType, horizon: int | None = None) -> None:
        self.folder, self.schema, self.horizon = folder.rstrip("/"), schema, horizon

    def batches(self, spark: SparkSession) -> list[int]:
        """The ids of the batches stored so far, in order."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))

    def between(self, spark: SparkSession, first: int, end: int) -> DataFrame:
        """Rows of the batches ``first`` to ``end - 1`` with their ``batch``; other folders are neither listed nor read."""
        shape = StructType([*self.schema.fields, StructField("batch", LongType())])
        wanted = [f"{self.folder}/batch={b}" for b in self.batches(spark) if first <= b < end]
        if not wanted:
            return spark.createDataFrame([], shape)
        return spark.read.schema(shape).option("basePath", self.folder).parquet(*wanted)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows written so far, with their ``batch``."""
        shape = StructType([*self.schema.fields, StructField("batch", LongType())])
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.createDataFrame([], shape)
        return spark.read.schema(shape).parquet(self.folder)

    def current(self, spark: SparkSession, key: Sequence[str]) -> DataFrame:
        """The rows in force: of the rows with one complete key the smallest id, and all rows whose key has a NULL."""
        rows = self.rows(spark).drop("batch")
        least = rows.dropna(subset=list(key)).groupBy(*key).agg(F.min("id").alias("id")).select("id")
        whole = F.lit(True)
        for name in key:
            whole = whole & F.col(name).isNotNull()
        return rows.filter(whole).join(least, "id", "left_semi").unionByName(rows.filter(~whole))

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows of earlier batches within the horizon; a replay does not see its own first attempt."""
        if self.horizon is None:
            return self.rows(spark).filter(F.col("batch") < batch_id).drop("batch")
        return self.between(spark, batch_id - self.horizon, batch_id).drop("batch")

    def write(self, accepted: DataFrame, batch_id: int) -> None:
        """Store the rows of a batch, replacing an earlier attempt of the same batch."""
        accepted.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")
