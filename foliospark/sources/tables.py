"""Small helpers on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Written tables up to this measured size are broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024
# A slice of written tables has a quarter of their bytes, but for these bounds.
SLICES, SLICE_BYTES = 4, (32 * 1024 * 1024, 256 * 1024 * 1024)


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, folder = _folder(spark, path)
    return filesystem.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work table or folder; one that is not there does no harm."""
    filesystem, folder = _folder(spark, path)
    filesystem.delete(folder, True)


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty folder, which says that what it is named after is whole."""
    filesystem, folder = _folder(spark, path)
    filesystem.mkdirs(folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    filesystem, folder = _folder(spark, path)
    return [f.getPath().getName() for f in filesystem.listStatus(folder)] if filesystem.exists(folder) else []


def write_texts(texts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A table of texts in the codec that leaves a third less of them than Spark's default."""
    texts.write.mode(mode).option("compression", "zstd").parquet(path)


def slices(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files of written tables in groups of about equal bytes, for work that has to leave little on disk at a time."""
    files = []
    for path in paths:
        filesystem, folder = _folder(spark, path)
        found = [(f.getPath(), f.getLen()) for f in filesystem.listStatus(folder)]
        files += [(p.toString(), n) for p, n in found if not p.getName().startswith(("_", "."))]
    least, most = SLICE_BYTES
    size = min(most, max(least, sum(n for _, n in files) // SLICES))
    groups, held = [], size
    for path, n in files:
        if held >= size:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += n
    return groups


def small_broadcast(written: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table marked for broadcast when its measured size allows it, else as it is."""
    size = written.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(written) if size <= limit else written
