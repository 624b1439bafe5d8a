"""What the operators share: input columns, scratch tables, batch sizes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import streakline
from streakline.session import scratch_path

#: The white space that separates words: space and U+0009 to U+000D.
SPACE = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
ORIGINAL = "__row"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Before Python runs on executors: the package's modules travel with the application, so that no installation is
    needed there, and Arrow batches have at most 256 rows or about 4 MB, so that long texts do not pile up."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(streakline.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="streakline-")) / "streakline_modules.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for module in sorted(package.rglob("*.py")):
                out.write(module, module.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ORIGINAL)


def unpacked(df: DataFrame, columns: list[str], **new: Column | str) -> DataFrame:
    """The original columns, and new ones, which replace original columns of the same name."""
    taken = {name.lower() for name in new}
    kept = [F.col(ORIGINAL)[c].alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in new.items()])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
