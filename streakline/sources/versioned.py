"""A table as immutable files and numbered lists of them: versions to read back, and merges that rewrite only the
files that hold a key of the source.

Data files are written once, below a name of their own. A version is a small list of the files it consists of; it
becomes visible by one rename, which fails if another writer has taken the number. A run that is lost at any step
leaves the version before it as it was, and readers keep the files of the version they have opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streakline.operators.cleaning import upsert
from streakline.session import scratch_path


class Conflict(RuntimeError):
    """Another writer published the version first; nothing was changed."""


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str
    schema: T.StructType

    # --- versions ---------------------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The numbers of the published versions, in order."""
        folder = self._path("versions")
        if not self._files().exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files().listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def newest(self) -> int | None:
        return max(self.versions(), default=None)

    def files(self, version: int | None = None) -> list[str]:
        """The data files of a version (the newest by default): a path per file."""
        version = self.newest() if version is None else version
        if version is None:
            return []
        if version not in self.versions():
            raise ValueError(f"{self.root} has no version {version}")
        listed = self.spark.read.schema("file string").parquet(f"{self.root}/versions/{version:010d}")
        return sorted(row["file"] for row in listed.collect())

    def as_of(self, version: int | None = None) -> DataFrame:
        """The table at a version. Later versions do not change what this frame reads."""
        files = self.files(version)
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def _publish(self, files: Sequence[str], before: int | None) -> int:
        pending = f"versions/.pending-{uuid.uuid4().hex}"
        rows = self.spark.createDataFrame([(file,) for file in files], "file string")
        rows.coalesce(1).write.parquet(f"{self.root}/{pending}")
        version = 0 if before is None else before + 1
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(self._path(pending)), context.makeQualified(self._path(f"versions/{version:010d}")), plain)
        except Exception as error:
            if version in self.versions():
                raise Conflict(f"version {version} of {self.root} exists") from error
            raise
        return version

    # --- writes -----------------------------------------------------------------------------------

    def _written(self, df: DataFrame) -> list[str]:
        """The rows as new data files, as they are partitioned."""
        name = f"data/{uuid.uuid4().hex}"
        df.select(*self.schema.names).write.parquet(f"{self.root}/{name}")
        statuses = self._files().listStatus(self._path(name))
        paths = [status.getPath() for status in statuses]
        return [path.toString() for path in paths if path.getName().endswith(".parquet")]

    def replace(self, df: DataFrame) -> int:
        """A new version that holds the rows of ``df`` alone; ``df`` may read the table."""
        before = self.newest()
        return self._publish(self._written(df), before)

    def append(self, df: DataFrame) -> int:
        """A new version with these rows beside those of the newest."""
        before = self.newest()
        return self._publish([*self.files(before), *self._written(df)], before)

    def merge(self, source: DataFrame, keys: Sequence[str]) -> int | None:
        """Merges ``source`` into the newest version: rows with a known key are replaced, others added; its number, or
        the newest one's if ``source`` is empty. A key that the source has twice raises, NULL keys match nothing.

        Only files that hold a key of the source are written again. They are found by a semi-join that reads the key
        columns, within the source's range of the first key, so that row groups outside it are skipped; the driver
        holds file names only.
        """
        before = self.newest()
        path = scratch_path(self.spark, "merge_source")
        source.select(*self.schema.names).write.parquet(path)
        source = self.spark.read.schema(self.schema).parquet(path)
        low, high = source.agg(F.min(keys[0]), F.max(keys[0])).first()
        if source.isEmpty():
            return before
        files = self.files(before)
        touched: set[str] = set()
        if files and low is not None:
            keyed = self.as_of(before).where(F.col(keys[0]).between(F.lit(low), F.lit(high)))
            held = keyed.select(*keys, F.col("_metadata.file_path").alias("_file")).join(source.select(*keys), list(keys), "left_semi")
            touched = {self._path_of(row["_file"]) for row in held.select("_file").distinct().collect()}
        rewritten = [file for file in files if self._path_of(file) in touched]
        target = self.spark.read.schema(self.schema).parquet(*rewritten) if rewritten else self.spark.createDataFrame([], self.schema)
        merged = upsert(target, source, keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
        return self._publish([*[f for f in files if f not in set(rewritten)], *self._written(merged)], before)

    def _path_of(self, file: str) -> str:
        """The path of a file name or of its address, however the file system spells it."""
        jvm = self.spark.sparkContext._jvm
        uri = jvm.java.net.URI(file) if ":" in file.split("/", 1)[0] else jvm.org.apache.hadoop.fs.Path(file).toUri()
        return uri.getPath()

    def vacuum(self, keep: int = 1) -> int:
        """Forgets all but the newest ``keep`` versions and deletes the data folders that none of them uses, also those
        of lost runs; how many. Not while another writer is at work, or a reader on a forgotten version."""
        versions = self.versions()
        kept = versions[-keep:]
        used = {self._path_of(file).rsplit("/", 2)[1] for version in kept for file in self.files(version)}
        system = self._files()
        for version in versions[:-keep]:
            system.delete(self._path(f"versions/{version:010d}"), True)
        folders = [status.getPath() for status in system.listStatus(self._path("data"))]
        unused = [folder for folder in folders if folder.getName() not in used]
        for folder in unused:
            system.delete(folder, True)
        return len(unused)
