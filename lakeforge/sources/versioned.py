"""A table of Parquet files with versions: changes rewrite only the files that hold a changed key, and count at once or not
at all.

path/data/<commit>/ holds the files of one commit, which never change; path/manifests/<commit>/ lists the live files of one
version (rows and least and greatest key of each, as Parquet); path/versions/<number> names a manifest. A reader takes the
greatest number. A commit writes data and manifest first and then makes the next number's file by a rename that fails where
it exists already: until then nothing has changed, and of two writers at once one is refused.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeforge.sources.sinks import filesystem, remove


class Conflict(RuntimeError):
    """Another writer has made the version."""


class VersionedTable:
    """Rows with a key. Their order by `cluster` (then the key) decides which rows share a file, so that files can be left
    out by their least and greatest key."""

    def __init__(self, spark: SparkSession, path: str, key: str, cluster: tuple[str, ...] = ()):
        self.spark, self.path, self.key, self.cluster = spark, path.rstrip("/"), key, cluster

    # --- versions ---

    def version(self) -> int:
        """The last one; 0 before the first commit."""
        fs, where = filesystem(self.spark, f"{self.path}/versions")
        if not fs.exists(where):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def named(self, version: int) -> tuple[str, str]:
        """A version's manifest and its rows' schema."""
        text = self.spark.read.text(f"{self.path}/versions/{version:020d}", wholetext=True).first()[0]
        manifest, schema = text.split("\n", 1)
        return manifest, schema

    def manifest(self, version: int | None = None) -> DataFrame:
        """file (below path/data), n, low, high of the version's live files."""
        name, _ = self.named(version or self.version())
        return self.spark.read.parquet(f"{self.path}/manifests/{name}")

    def files(self, version: int | None = None) -> list[str]:
        return sorted(r["file"] for r in self.manifest(version).select("file").collect())

    def read(self, version: int | None = None, *, only: list[str] | None = None) -> DataFrame:
        version = version or self.version()
        schema = StructType.fromJson(json.loads(self.named(version)[1]))
        files = self.files(version) if only is None else only
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/data/{f}" for f in files))

    # --- commits ---

    def swap(self, version: int, manifest: str, schema: StructType) -> None:
        """Makes the version, by a rename that fails where another has made it."""
        fs, made = filesystem(self.spark, f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = fs.create(made, False)
        out.write(bytearray(f"{manifest}\n{schema.json()}".encode()))
        out.close()
        jvm = self.spark._jvm.org.apache.hadoop.fs
        to = jvm.Path(f"{self.path}/versions/{version:020d}")
        context = jvm.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(made, to, self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))
        except Exception as e:
            fs.delete(made, False)
            if fs.exists(to):
                raise Conflict(f"version {version} of {self.path} is there already") from e
            raise

    def stored(self, rows: DataFrame, commit: str) -> DataFrame:
        """Writes a commit's files and returns their lines of a manifest."""
        to = f"{self.path}/data/{commit}"
        ordered = [*self.cluster, *([self.key] if self.key not in self.cluster else [])]
        rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered).write.parquet(to)
        kind = rows.schema[self.key].dataType
        there = self.spark.read.schema(rows.schema).parquet(to)
        file = F.concat(F.lit(f"{commit}/"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
        each = there.select(file.alias("file"), self.key).groupBy("file")
        return each.agg(F.count("*").alias("n"), F.min(self.key).cast(kind).alias("low"), F.max(self.key).cast(kind).alias("high"))

    def commit(self, lines: DataFrame, name: str, after: int, schema: StructType) -> int:
        """lines become the manifest of the version after `after`."""
        lines.coalesce(1).write.parquet(f"{self.path}/manifests/{name}")
        self.swap(after + 1, name, schema)
        return after + 1

    def overwrite(self, rows: DataFrame) -> int:
        """All rows anew, as a version."""
        name, after = uuid.uuid4().hex, self.version()
        return self.commit(self.stored(rows, name), name, after, rows.schema)

    def touched(self, keys: DataFrame, version: int) -> list[str]:
        """Live files that hold one of the keys: first those whose range of keys meets the keys' range, then by a scan of
        their key column alone. The names of files are all that reaches the driver."""
        ends = keys.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high")).first()
        if ends["low"] is None:
            return []
        near = [r["file"] for r in self.manifest(version).where((F.col("high") >= F.lit(ends["low"])) & (F.col("low") <= F.lit(ends["high"]))).select("file").collect()]
        if not near:
            return []
        names = F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2), "/")
        rows = self.read(version, only=near).select(self.key, names.alias("file"))
        return sorted(r["file"] for r in rows.join(keys, self.key, "left_semi").select("file").distinct().collect())

    def upsert(self, delta: DataFrame, deleted: DataFrame | None = None) -> int:
        """delta's rows take the place of those with their keys, deleted's keys go (out of delta, too); returns the version.

        A key is in delta once; rows with a null key are never matched and stay, and are added from delta. A version in
        which nothing changes is made all the same. A failure before the last step leaves the table as it was, but for files
        that vacuum() removes."""
        after, name = self.version(), uuid.uuid4().hex
        gone = delta.select(self.key) if deleted is None else delta.select(self.key).union(deleted.select(self.key))
        gone = gone.where(F.col(self.key).isNotNull()).distinct()
        files = self.touched(gone, after)
        base = self.read(after, only=files)
        new = delta if deleted is None else delta.join(deleted.select(self.key).distinct(), self.key, "left_anti")
        rows = base.join(gone, self.key, "left_anti").select(base.columns).unionByName(new.select(base.columns))
        lines = self.manifest(after).where(~F.col("file").isin(files)).unionByName(self.stored(rows, name))
        return self.commit(lines, name, after, base.schema)

    def vacuum(self, keep: int = 1) -> int:
        """Removes what only versions before the last `keep` ones, or no version at all, refer to; returns how many files of
        rows went. Not while another commit is being written."""
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        files = {f for v in kept for f in self.files(v)}
        commits, manifests = {f.split("/")[0] for f in files}, {self.named(v)[0] for v in kept}
        went = 0
        for s in self.listed("data"):
            commit = s.getPath().getName()
            mine = [x.getPath() for x in self.listed(f"data/{commit}") if x.getPath().getName().endswith(".parquet")]
            dead = [x for x in mine if f"{commit}/{x.getName()}" not in files]
            went += len(dead)
            for x in dead if commit in commits else [s.getPath()]:
                remove(self.spark, x.toString())
        for s in self.listed("manifests"):
            if s.getPath().getName() not in manifests:
                remove(self.spark, s.getPath().toString())
        for s in self.listed("versions"):
            name = s.getPath().getName()
            if name.startswith(".") or int(name) not in kept:
                remove(self.spark, s.getPath().toString())
        return went

    def listed(self, folder: str) -> list:
        fs, where = filesystem(self.spark, f"{self.path}/{folder}")
        return list(fs.listStatus(where)) if fs.exists(where) else []
