"""Files as tables: source documents, artifacts, layout JSON, Markdown and saved state.

The key of a file is its plain path: Spark's metadata column holds it percent-encoded and is decoded
here, so that listings and contents join.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions import paths as P
from foliospark.functions.text import without_bom
from foliospark.operators.calls import list_folders, locate, open_files, open_texts, read_ranges
from foliospark.session import shared_path

# Bytes of parts that one task reads on average, and of neighbouring parts that stay together.
TASK_BYTES = 128 * 1024 * 1024
RUN_BYTES = 4 * 1024 * 1024


def _kind(path: str) -> str:
    kind = locate(path)[0].get_file_info(locate(path)[1]).type.name
    return {"File": "file", "Directory": "folder"}.get(kind, "missing")


def list_files(
    spark: SparkSession, path: str, recursive: bool = True, folders: bool = False
) -> DataFrame:
    """``doc_id, path, mtime, length`` per file, empty and hidden ones included; with ``folders``
    those too, and a column ``folder`` to tell them.

    Spark's own file sources leave out empty files and names that start with ``.`` or ``_``. So
    the folders of each level are dealt to the tasks, which list what lies right in them; every
    level is written to the shared folder before the next one. No contents are read and no list
    goes through the driver or, beyond one folder, through one task.
    """
    schema = "path string, folder boolean, micros bigint, length bigint"
    filesystem, inner, prefix = locate(path)
    top = filesystem.get_file_info(inner)
    row = (prefix + inner, top.type.name == "Directory", (top.mtime_ns or 0) // 1000, top.size or 0)
    found = spark.createDataFrame([row], schema)
    level = found.mapInArrow(list_folders(), schema)
    if recursive:
        work, depth = shared_path(spark, "listing"), 0
        tasks = spark.sparkContext.defaultParallelism * 4
        while True:
            level.write.parquet(f"{work}/depth={depth}")
            below = spark.read.schema(schema).parquet(f"{work}/depth={depth}").filter("folder")
            if below.isEmpty():
                break
            level = below.repartition(tasks).mapInArrow(list_folders(), schema)
            depth += 1
        level = spark.read.schema(schema).parquet(*[f"{work}/depth={d}" for d in range(depth + 1)])
    if not folders:
        level = level.filter(~F.col("folder"))
    return level.select(
        P.document_id(F.col("path")).alias("doc_id"),
        "path",
        F.timestamp_micros("micros").alias("mtime"),
        "length",
        *(["folder"] if folders else []),
    )


def list_sources(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """The manifest of PDF documents: one file, or a folder's own files, or all below it.

    The suffix is matched in any case. Anything but a PDF file or a folder is an error; an empty
    folder gives an empty manifest. Sort with :func:`in_path_order` where the order matters.
    """
    kind = _kind(path)
    if kind == "missing" or (kind == "file" and not path.lower().endswith(".pdf")):
        raise ValueError(f"input must be a PDF file or a folder: {path}")
    files = list_files(spark, path, recursive).filter(F.lower("path").endswith(".pdf"))
    return files.withColumn("stem", P.stem(F.col("path"))).withColumn("file", P.file_name(F.col("path")))


def in_path_order(files: DataFrame) -> DataFrame:
    return files.orderBy(P.path_order(F.col("path")))


def resolve_artifacts(manifest: DataFrame, listing: DataFrame, output: str) -> DataFrame:
    """The artifact folder of each document and the layout and Markdown files in it.

    ``manifest`` has ``stem``, ``listing`` the paths below ``output``; with a column ``folder``
    (see :func:`list_files`) folders without any file count as well. The folder is
    ``stem/auto``, else the first ``stem/*/auto``, else ``stem``; within it the layout file named
    after the folder's parent, else the first one; the Markdown named after the document, else
    the first that is not a translation written earlier. Missing ones are NULL.

    Both picks are one ``min`` over a struct that compares folder rank, folder and file rank in
    turn: one aggregation with map-side partials, no window over the files of a document.
    """
    root = re.sub(r"^file:/*", "/", output).rstrip("/") + "/"
    suffixes = sorted({*K.LANGUAGE_SUFFIX.values(), K.OTHER_LANGUAGE_SUFFIX})
    parts = F.split(F.substr("path", F.lit(len(root) + 1)), "/")
    folder_row = F.col("folder") if "folder" in listing.columns else F.lit(False)
    files = listing.filter(F.col("path").startswith(root)).select(
        "path", folder_row.alias("folder"), parts.alias("parts"), F.size(parts).alias("n")
    )
    # Parts that are folders: all of a folder's own path, all but the name of a file's.
    depth = F.when(F.col("folder"), F.col("n")).otherwise(F.col("n") - 1)
    stem, second, third = F.col("parts")[0], F.get("parts", F.lit(1)), F.get("parts", F.lit(2))

    def folder(rank: int, depth: int):
        return F.struct(F.lit(rank).alias("rank"), F.slice("parts", 1, depth).alias("dir"))

    folders = F.array_compact(
        F.array(
            F.when((second == K.ARTIFACT_DIR) & (depth > 1), folder(0, 2)),
            F.when((third == K.ARTIFACT_DIR) & (depth > 2), folder(1, 3)),
            F.when(depth > 0, folder(2, 1)),
        )
    )
    name = F.element_at("parts", -1)
    rows = files.select("path", "folder", "parts", "n", stem.alias("stem"), name.alias("name"), F.explode(folders).alias("f"))
    inside = (F.size("f.dir") == F.col("n") - 1) & ~F.col("folder")
    parent_name = F.when(F.size("f.dir") > 1, F.element_at("f.dir", -2)).otherwise(
        output.rstrip("/").rsplit("/", 1)[-1]
    )
    ours = F.col("name").isin(
        *[F.concat("stem", F.lit(f"_{suffix}{K.MARKDOWN_SUFFIX}")) for suffix in suffixes]
    )
    layout_rank = F.when(
        inside & (F.col("name") == F.concat(parent_name, F.lit(K.LAYOUT_SUFFIX))), 0
    ).when(inside & F.col("name").endswith(K.LAYOUT_SUFFIX), 1)
    markdown_rank = F.when(
        inside & (F.col("name") == F.concat("stem", F.lit(K.MARKDOWN_SUFFIX))), 0
    ).when(inside & F.col("name").endswith(K.MARKDOWN_SUFFIX) & ~ours, 1)

    def best(rank):
        return F.min(
            F.struct(
                F.col("f.rank").alias("dir_rank"),
                F.col("f.dir").alias("dir"),
                F.coalesce(rank, F.lit(9)).alias("rank"),
                F.when(rank.isNotNull(), F.col("path")).alias("path"),
            )
        )

    picked = rows.groupBy("stem").agg(best(layout_rank).alias("l"), best(markdown_rank).alias("m"))
    return manifest.join(
        picked.select(
            "stem",
            F.concat(F.lit(root), F.array_join("l.dir", "/")).alias("artifact_dir"),
            F.col("l.path").alias("layout_path"),
            F.col("m.path").alias("markdown_path"),
        ),
        "stem",
        "left",
    )


def listable(path: str) -> bool:
    """Whether this is a file or folder, not a pattern, in a store that the tasks can list and open."""
    try:
        return _kind(path) != "missing"
    except (OSError, ValueError, NotImplementedError):
        return False


def shown(path: str):
    """Whether Spark's file sources would take a file of a listing of ``path``: no part of its path below is hidden."""
    _, inner, prefix = locate(path)
    below = F.substring("path", len(prefix + inner.rstrip("/")) + 1, 1 << 30)
    name = F.when(below == "", P.file_name(F.col("path"))).otherwise(below)
    return ~name.rlike(r"(^|/)(\.|_(?!metadata|common_metadata)[^/=]*(/|$))|\._COPYING_(/|$)")


def contents(listing: DataFrame) -> DataFrame:
    """``path, content`` of listed files (``path``, ``length``), opened in the tasks, without byte order mark.

    An empty file has no row, and a lost one is an error, as with Spark's own reader. That one puts at most some 32 small
    files into a task, so its tasks grow with the number of files; here a task has 1,024 or more of them.
    """
    n, size = listing.agg(F.count(F.lit(1)), F.sum("length")).first()
    most = listing.sparkSession.sparkContext.defaultParallelism * 4
    tasks = max(1, min(most, n // 1024), -(-int(size or 0) // TASK_BYTES))
    opened = listing.select("path").repartition(tasks).mapInArrow(open_files(), "path string, bytes binary")
    return opened.select("path", without_bom(F.col("bytes").cast("string")).alias("content"))


def read_texts(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """``path, content`` per file, read whole and without byte order mark.

    An empty file has no row; join from the listing to keep it. Folders are listed and files opened by the tasks. Path
    patterns, brackets in ``glob`` and stores that only Spark knows go through Spark's reader.
    """
    several = [p.rstrip("/") or p for p in ([paths] if isinstance(paths, str) else paths)]
    if several and re.fullmatch(r"[^\[\]{}\\]*", glob) and all(listable(p) for p in several):
        name = re.escape(glob).replace(r"\*", ".*").replace(r"\?", ".")
        found = None
        for path in several:
            listed = list_files(spark, path).filter(shown(path) & P.file_name(F.col("path")).rlike(f"(?s)^{name}$"))
            listed = listed.select("path", "length")
            found = listed if found is None else found.unionByName(listed)
        return contents(found if len(several) == 1 else found.dropDuplicates(["path"]))
    texts = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(
        paths, wholetext=True
    )
    return texts.select(
        P.plain_path(F.col("_metadata.file_path")).alias("path"),
        without_bom(F.col("value")).alias("content"),
    )


def read_parts(listing: DataFrame, key: str = "doc_id", part_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """(``key``, ``number``, ``piece``): the texts of listed files (``path``, ``length``) in parts.

    A file of any size is read by as many tasks as it has runs of parts, 4 MiB or one part. Parts are cut at bytes, and
    a character belongs to the part in which it begins. A part that cannot be read is NULL. The number of tasks follows the
    bytes, not the parts.
    """
    kind = listing.schema[key].dataType.simpleString()
    last = F.greatest(F.ceil(F.col("length") / part_bytes), F.lit(1)).cast("bigint") - 1
    parts = listing.select(key, "path", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("number"))
    tasks = listing.sparkSession.sparkContext.defaultParallelism * 4
    bytes_of_all = listing.agg(F.sum("length")).first()[0] or 0
    tasks = max(tasks, -(-int(bytes_of_all) // max(4 * part_bytes, TASK_BYTES)))
    run = F.floor(F.col("number") / max(1, RUN_BYTES // part_bytes))
    return parts.repartition(tasks, "path", run).mapInArrow(
        read_ranges(part_bytes), f"`{key}` {kind}, number bigint, piece string"
    )


def read_layout(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, layout_json`` per layout file, for ``parse_layout``."""
    return read_texts(spark, paths, f"*{K.LAYOUT_SUFFIX}").withColumnRenamed("content", "layout_json")


def read_markdown(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_texts(spark, paths, f"*{K.MARKDOWN_SUFFIX}")


def read_artifacts(
    spark: SparkSession, manifest: DataFrame, output: str, parallelism: int | None = None
) -> DataFrame:
    """``manifest`` with the ``layout_json`` and ``markdown`` texts found for each document.

    For output folders a parser has already written; what is missing is NULL. Paths are resolved
    first; the tasks then open just those files, so no text is shuffled.
    """
    found = resolve_artifacts(manifest, list_files(spark, output, folders=True), output)
    tasks = parallelism or spark.sparkContext.defaultParallelism * 4
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return found.repartition(tasks).mapInArrow(
        open_texts({"layout_path": "layout_json", "markdown_path": "markdown"}),
        f"{columns}, layout_json string, markdown string",
    )


def read_saved_state(
    spark: SparkSession,
    manifest: DataFrame,
    paths: str | list[str],
    glob: str = "*state.json",
    stage_names: dict[str, str] | None = None,
    target_lang: str = K.DEFAULT_TARGET_LANG,
) -> DataFrame:
    """Stage events from saved state files, one JSON object per document.

    A file belongs to the document of ``manifest`` with its source path. ``stage_names`` maps a
    file's stage names to ours where they differ. A file that is not JSON gives no events, so its
    document starts afresh. The one modification time of a file counts for each of its finished
    stages, and its translate stage for ``target_lang``.
    """

    def top(name: str, kind: str):
        return F.try_variant_get("saved", f"$.{name}", kind)

    rows = (
        read_texts(spark, paths, glob)
        .withColumn("saved", F.try_parse_json("content"))
        .select(
            F.col("path").alias("run_id"),
            top("source_path", "string").alias("path"),
            top("source_mtime", "double").alias("seconds"),
            F.explode(top("stages", "map<string,variant>")).alias("name", "entry"),
        )
    )
    stage = F.col("name")
    for theirs, mine in (stage_names or {}).items():
        stage = F.when(F.col("name") == theirs, mine).otherwise(stage)

    def entry(name: str, default: str):
        return F.coalesce(F.try_variant_get("entry", f"$.{name}", "string"), F.lit(default))

    status = entry("status", K.PENDING)
    ts = F.try_to_timestamp(F.nullif(entry("timestamp", ""), F.lit("")))
    mtime = F.timestamp_micros((F.col("seconds") * 1000000).cast("bigint"))
    return (
        rows.join(manifest.select("doc_id", "path"), "path")
        .withColumn("stage", stage)
        .select(
            "doc_id",
            "stage",
            F.when(F.col("stage") == K.STAGE_TRANSLATE, target_lang).alias("target_lang"),
            status.alias("status"),
            F.coalesce(ts, F.timestamp_seconds(F.lit(0))).alias("ts"),
            entry("error", "").alias("error"),
            F.when(status == K.DONE, mtime).alias("source_mtime"),
            "run_id",
        )
    )
