"""Sources. Listings never read file contents: the content column is pruned away."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import canonical_path, image_path
from ..schemas import ATTRIBUTES, FILES, MANIFEST
from ..storage import settle, ship
from .versions import ChunkTable
from .writers import replace_folder

# Extensions, whether case counts, whether folders below are read, word that a name must not hold.
PRESETS = {
    "raw": (["jpg", "png", "jpeg"], True, True, None),
    "pool": (["jpg", "jpeg", "png", "webp"], False, True, None),
    "extract": (["jpg", "png"], True, False, "metadata"),
    "adapter": (["png", "jpg", "jpeg"], False, True, None),
}


def preset_pattern(preset: str) -> str:
    """The file name pattern of a preset: an extension after a name, in any case where case doesn't count."""
    extensions, case, _, _ = PRESETS[preset]
    either = lambda x: x if case else "".join(f"[{c}{c.upper()}]" for c in x)
    return "?*.{" + ",".join(map(either, extensions)) + "}"


def list_files(spark: SparkSession, root: str | list[str], recursive: bool = True, preset: str | None = None, since: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of the files under ``root``; canonical paths.

    ``preset`` and ``since`` (a UTC time such as 2024-01-31T12:00:00; files modified after it) are taken by the listing itself,
    so files of other kinds or older ones never become rows or tasks. A flat preset lists no folder below unless ``recursive``.
    """
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if preset:
        scan = scan.option("pathGlobFilter", preset_pattern(preset))
    if since:
        scan = scan.option("modifiedAfter", since).option("timeZone", "UTC")
    found = scan.load(root).select(canonical_path(F.col("path")).alias("path"), "modificationTime", "length")
    without = PRESETS[preset][3] if preset else None
    return found.where(~F.contains(F.regexp_extract("path", r"([^/]*)$", 1), F.lit(without))) if without else found


def _entries(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    """(path, is a folder, modified in milliseconds, length) of what lies in a folder; names that Spark hides are left out."""
    hidden = lambda n: n.startswith(".") or n.endswith("._COPYING_") or (n.startswith("_") and "=" not in n)
    store = re.match(r"([a-z][a-z0-9+.-]*://[^/]*)(/.*)", folder)
    if not store:
        with os.scandir(folder) as found:
            for e in found:
                if not hidden(e.name):
                    info = e.stat()
                    yield f"{folder.rstrip('/')}/{e.name}", e.is_dir(), int(info.st_mtime * 1000), info.st_size
        return
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(store[1] + "/")
    for e in system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}{store[2]}")):
        if not hidden(e.base_name):
            yield f"{folder.rstrip('/')}/{e.base_name}", e.type == fs.FileType.Directory, (e.mtime_ns or 0) // 1_000_000, e.size or 0


def list_in_tasks(spark: SparkSession, root: str) -> DataFrame:
    """(path, modificationTime, length) of all files under ``root``, listed by the tasks, a folder at a time, level by level.

    The driver holds no file's name, so it lists as many files as the folders hold; ``list_files`` keeps all of them on the driver. The
    store must be one that pyarrow opens, as for ``read_named``. Names that Spark's readers hide are left out here too; files without a byte, which ``list_files`` leaves out, are listed.
    """
    ship(spark)
    names = ["path", "folder", "modified", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                held = []
                for entry in _entries(folder):
                    held.append(entry)
                    if len(held) == 10_000:
                        yield packed(held)
                        held = []
                if held:
                    yield packed(held)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)

    folders, out = spark.createDataFrame([(root,)], "path string").select(canonical_path(F.col("path")).alias("path")), None
    n = 1
    while n:
        level = settle(folders.repartition(min(n, 10_000)).mapInArrow(run, "path string, folder boolean, modified long, length long"))
        files = level.where("not folder").select("path", F.timestamp_millis("modified").alias("modificationTime"), "length")
        out = files if out is None else out.unionAll(files)
        folders = level.where("folder").select("path")
        n = folders.count()
    return out


def save_snapshot(listed: DataFrame, path: str) -> DataFrame:
    """Keep a listing at ``path``, in place of an earlier one, to compare later ones with."""
    replace_folder(listed, path, lambda to: listed.select(*FILES.names).write.parquet(to))
    return read_snapshot(listed.sparkSession, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILES).parquet(path)


def new_files(listed: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Files of a listing that a snapshot doesn't have, whatever their times: a file that is moved in keeps its own."""
    return listed.join(snapshot.select("path"), "path", "left_anti")


def filter_images(df: DataFrame, preset: str = "pool", path: str = "path", root: str | None = None, recursive: bool = True) -> DataFrame:
    """Rows whose path fits a preset. A flat preset needs ``root`` to tell; with ``recursive`` it takes folders below too."""
    extensions, case, deep, without = PRESETS[preset]
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    suffix = F.regexp_extract(name, r"^.+\.([^.]+)$", 1)
    out = df.where((suffix if case else F.lower(suffix)).isin(extensions))
    if without:
        out = out.where(~F.contains(name, F.lit(without)))
    if not deep and not recursive and root is not None:
        folder = F.regexp_extract(canonical_path(F.col(path)), r"^(.*)/[^/]*$", 1)
        out = out.where(folder == canonical_path(F.lit(root.rstrip("/"))))
    return out


def count_images(df: DataFrame, preset: str = "adapter") -> DataFrame:
    """One row with n_images."""
    return filter_images(df, preset).agg(F.count("*").alias("n_images"))


def read_images(spark: SparkSession, paths: str | list[str], drop_invalid: bool = False, pattern: str | None = None) -> DataFrame:
    """(path, readable, image): all decoded images below folders, BGR; what can't be decoded has readable false and height -1.

    ``pattern`` keeps files by name in the scan itself. Images that a table names are read by ``read_named``.
    """
    scan = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).option("recursiveFileLookup", "true")
    found = (scan.option("pathGlobFilter", pattern) if pattern else scan).load(paths)
    return found.select(image_path(F.col("image.origin")).alias("path"), (F.col("image.height") > 0).alias("readable"), "image")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("header", True).csv(path)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ATTRIBUTES).parquet(path)


def read_chunks(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The chunks of a table's newest version, or of one of its earlier ones, with their chunk_id; an error if there is none."""
    return ChunkTable(spark, path).read(version)


def read_json_doc(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def newest_new_file(after: DataFrame, before: DataFrame) -> DataFrame:
    """(path): of the files that are in ``after`` only, the newest; of equally new ones the greatest path. No row if there is none."""
    return new_files(after, before).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).where(F.col("path").isNotNull())
