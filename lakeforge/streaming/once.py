"""A sink for micro-batches in which a batch counts once, however often it is handed over."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.sources.sinks import filesystem


class OncePerBatch:
    """For foreachBatch. Rows of batch n go to path/rows/batch_no=n, which is written whole each time, and then n is put in
    the log, path/log/<query>/: a batch that is in the log isn't written again, one that failed halfway is replaced, and
    readers see logged batches alone. Queries that write to one path keep separate logs and rows."""

    def __init__(self, path: str, query: str):
        self.path, self.query = path.rstrip("/"), query

    def rows_at(self, batch: int) -> str:
        return f"{self.path}/rows/query_name={self.query}/batch_no={batch}"

    def logged(self, spark: SparkSession) -> list[int]:
        fs, where = filesystem(spark, f"{self.path}/log/{self.query}")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where)) if fs.exists(where) else []

    def __call__(self, rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        fs, mark = filesystem(spark, f"{self.path}/log/{self.query}/{batch}")
        if fs.exists(mark):
            return
        rows.write.mode("overwrite").parquet(self.rows_at(batch))
        fs.mkdirs(mark.getParent())
        fs.create(mark, True).close()

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """The rows of all logged batches, with query_name and batch_no."""
        at = [self.rows_at(n) for n in self.logged(spark)]
        kind = f"{schema}, query_name string, batch_no long"
        if not at:
            return spark.createDataFrame([], kind)
        return spark.read.option("basePath", f"{self.path}/rows").schema(kind).parquet(*at)


def newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that a query updates again and again, those of each key's last batch."""
    other = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*other), "batch_no").alias("last")).select(*keys, *(f"last.{c}" for c in other))
