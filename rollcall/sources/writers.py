"""Sinks. Outputs are replaced as a whole and chunks one by one; what stood there before stays whole until the new rows are."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ATTRIBUTES, CANDIDATES, DATASET, MANIFEST
from ..storage import settle
from .versions import ChunkTable, Version


def replace_folder(df: DataFrame, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then put it in its place. The old one goes last, and comes back if the new one can't be put there."""
    spark = df.sparkSession
    path = path.rstrip("/")
    staged, aside = (f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[-1]}.{what}.{uuid.uuid4().hex}" for what in ("new", "old"))
    here, new, old = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, aside))
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(staged)
        there = fs.exists(here)
        if there and not fs.rename(here, old):
            raise OSError(f"{path} can't be moved aside")
        if not fs.rename(new, here):
            if there:
                fs.rename(old, here)
            raise OSError(f"{staged} can't be moved to {path}")
        if there:
            fs.delete(old, True)
    finally:
        if fs.exists(new):
            fs.delete(new, True)


def write_dataset(df: DataFrame, path: str) -> None:
    """The final five columns as CSV (path/csv, in cluster and path order) and as Parquet (path/parquet)."""
    out = df.select(*DATASET.names)
    replace_folder(out, f"{path}/csv", lambda to: out.orderBy("cluster_id", "image_path").write.option("header", True).csv(to))
    replace_folder(out, f"{path}/parquet", lambda to: out.write.parquet(to))


def write_manifests(accepted: DataFrame, rejected: DataFrame, path: str) -> None:
    """Both manifests with a header even when empty; integers stay integers."""
    for name, df, schema in (("identity_manifest", accepted, MANIFEST), ("rejection_manifest", rejected, CANDIDATES)):
        out = df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
        replace_folder(out, f"{path}/{name}", lambda to, out=out: out.write.option("header", True).csv(to))


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row summary as one JSON document."""
    out = df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1)
    replace_folder(out, path, lambda to: out.write.text(to))


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines, written where they are."""
    replace_folder(df, path, lambda to: df.write.json(to))


def write_attributes(df: DataFrame, path: str) -> None:
    out = df.select(*ATTRIBUTES.names)
    replace_folder(out, path, lambda to: out.write.parquet(to))


def write_chunks(df: DataFrame, path: str, metrics: dict[str, Column] | None = None) -> Version:
    """Replace all chunks at once: none of an earlier, longer run stays. Rows that failed belong into ``df`` too."""
    return ChunkTable(df.sparkSession, path).replace(df, True, metrics=metrics)


def write_files(df: DataFrame, root: str) -> DataFrame:
    """Write each row (name, content binary) as a file of its own below ``root``, a folder all tasks reach; (name, n_bytes) of what was written."""
    uri = root if "://" in root or root.startswith("file:") else f"file://{root}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = FileSystem.from_uri(uri)
        for b in batches:
            for name, content in zip(b["name"], b["content"], strict=True):
                target = f"{folder}/{name}"
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(target) as out:
                    out.write(content)
            yield pd.DataFrame({"name": b["name"], "n_bytes": b["content"].map(len)})

    return settle(df.select("name", "content").mapInPandas(run, "name string, n_bytes long"))


def write_chunk(df: DataFrame, path: str, batch: str | None = None, before_publish: Callable[[Version], None] | None = None) -> Version:
    """Replace the chunks that ``df`` has rows of (column chunk_id) at once, keep the others; ``batch`` names the writer in the version."""
    return ChunkTable(df.sparkSession, path).replace(df, False, batch, before_publish)
