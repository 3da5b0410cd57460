"""Chunked tables that are replaced at once: staged files, and a version that names them, published last.

Below a table's folder lie data/write=<random>/ (the rows that one write staged, chunk_id among their columns, in files of ordinary size
however many chunks they hold), versions/<number>.json (one line for each write that the version still uses), and
versions/lines=<random>/ (what the version says of each chunk: its folder, the batch that wrote it, its totals). Lines are made and
merged by Spark, so the driver holds one entry for each write and none for a chunk. Readers take the highest number and open the folders it
names, so they see the table before a write or after it, never between. A write that ends midway leaves folders that no
version names. Two writers of the same number can't both publish: the number's file is made by a rename that fails if it is there.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..storage import settle

#: Totals of a chunk as they stand in a version; distributions as (value, rows).
TOTALS = "source_images bigint, extracted bigint, failed bigint, ages array<struct<age_group:int,n:bigint>>, genders array<struct<gender:int,n:bigint>>"
LINES = f"chunk_id bigint, folder string, batch string, {TOTALS}"


class Conflict(RuntimeError):
    """Another writer has published the version that this one wanted to."""


class Version:
    """A published state. ``writes``: of each folder it uses, how many chunks it holds and how many of them this version uses; ``metrics``:
    what the write that published it was asked of its rows.
    """

    def __init__(self, number: int, chunks: dict[int, dict] | None = None, writes: dict[str, dict] | None = None, lines: str | None = None, metrics: dict | None = None, read: Callable[[], DataFrame] | None = None):
        self.number, self.writes, self.lines, self.metrics, self._read = number, writes or {}, lines, metrics or {}, read
        if chunks is not None or read is None:
            self.__dict__["chunks"] = chunks or {}

    @cached_property
    def chunks(self) -> dict[int, dict]:
        """chunk_id to its line; brings all lines to the driver, which reads and writes of the table don't."""
        return {r["chunk_id"]: r.asDict(recursive=True) for r in self._read().collect()}

    @property
    def batches(self) -> set[str]:
        return {line["batch"] for line in self.chunks.values() if line.get("batch")}


class ChunkTable:
    """A table of chunks below ``path``, in any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *filter(None, parts)]))

    def _names(self, *parts: str) -> list[str]:
        where = self._path(*parts)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("versions") if re.fullmatch(r"\d+\.json", n)]

    def file(self, number: int) -> str:
        return f"{self.path}/versions/{number:020d}.json"

    def current(self, number: int | None = None) -> Version:
        """The newest version, or the one of ``number``; version 0 without chunks if nothing is published."""
        known = self.numbers()
        if number is None:
            number = known[-1] if known else 0
        if number == 0:
            return Version(0, {})
        if number not in known:
            raise ValueError(f"no version {number} of {self.path}")
        rows = [json.loads(r[0]) for r in self.spark.read.text(self.file(number)).collect()]
        if not rows or "lines" not in rows[0]:
            raise ValueError(f"version {number} of {self.path} has an earlier layout, a folder for each chunk")
        head, writes = rows[0], {w.pop("folder"): w for w in rows[1:]}
        return Version(number, None, writes, head["lines"], read=lambda: self._lines(head["lines"]))

    def _lines(self, name: str) -> DataFrame:
        return self.spark.read.schema(LINES).parquet(f"{self.path}/versions/{name}")

    def stage(self, df: DataFrame) -> str:
        """Write rows (chunk_id, ..) where no version looks yet; the folder's name. Rows of a chunk come together, many chunks in a file."""
        name = f"write=w{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/data/{name}")
        return name

    def publish(self, before: Version, chunks: dict[int, dict] | DataFrame, held: dict[str, int] | None = None) -> Version:
        """Make ``chunks`` (lines, or chunk_id to folder, batch, totals) the version after ``before``, or fail with Conflict.

        ``held``: how many chunks the folders hold that ``before`` doesn't know; by default those that are used.
        """
        number, name = before.number + 1, f"lines={uuid.uuid4().hex}"
        if isinstance(chunks, dict):
            names = [c.split(" ")[0] for c in LINES.split(", ")]
            chunks = self.spark.createDataFrame([tuple({"chunk_id": k, **v}.get(c) for c in names) for k, v in chunks.items()], LINES)
        chunks.write.parquet(f"{self.path}/versions/{name}")
        known = {f: w["chunks"] for f, w in before.writes.items()} | (held or {})
        used = {r["folder"]: r["n"] for r in self._lines(name).groupBy("folder").agg(F.count("*").alias("n")).collect()}
        writes = {f: {"chunks": known.get(f, n), "used": n} for f, n in sorted(used.items())}
        draft, final = self._path("versions", f".{uuid.uuid4().hex}"), self._jvm.org.apache.hadoop.fs.Path(self.file(number))
        out = self._fs.create(draft, False)
        out.write(bytearray("".join(json.dumps(x) + "\n" for x in ({"lines": name}, *({"folder": f, **w} for f, w in writes.items()))).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), none)
        except Exception as e:
            self._fs.delete(draft, False)
            self._fs.delete(self._path("versions", name), True)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(f"version {number} of {self.path} is there already") from e
            raise
        return Version(number, None, writes, name, read=lambda: self._lines(name))

    def replace(self, df: DataFrame, all_chunks: bool, batch: str | None = None, before_publish=None, metrics: dict[str, Column] | None = None) -> Version:
        """Replace the chunks that ``df`` has rows of, or with ``all_chunks`` the whole table, in one step.

        Totals of the new chunks are counted from the narrow columns of what was staged, so the rows are computed once.
        ``before_publish`` is called in between, with the version that will be replaced. ``metrics`` are aggregates over
        the rows, taken while they are written.
        """
        watch = Observation()
        no_chunk = F.raise_error(F.lit("a row has no chunk_id")).cast("long")
        df = df.select(*(c for c in df.columns if c != "chunk_id"), F.coalesce(F.col("chunk_id").cast("long"), no_chunk).alias("chunk_id")).hint("rebalance", "chunk_id")
        name = self.stage(df.observe(watch, *(c.alias(n) for n, c in metrics.items())) if metrics else df)
        before = self.current()
        if before_publish is not None:
            before_publish(before)
        lines = settle(self._totals(name, batch))
        held = {name: lines.count()}
        if not all_chunks and before.number:
            lines = self._lines(before.lines).join(lines.select("chunk_id"), "chunk_id", "left_anti").select(lines.columns).unionAll(lines)
        done = self.publish(before, lines, held)
        if metrics:
            done.metrics = watch.get
        return done

    def _totals(self, name: str, batch: str | None) -> DataFrame:
        """The lines of what was staged, counted from its narrow columns."""
        rows = self.spark.read.parquet(f"{self.path}/data/{name}")
        by = lambda df: df.groupBy("chunk_id")
        none = {"ages": "age_group", "genders": "gender"}
        if "saved" not in rows.columns:
            out = by(rows).agg(*(F.lit(None).cast("long").alias(c) for c in ("source_images", "extracted", "failed")))
            out = out.withColumns({c: F.lit(None).cast(f"array<struct<{v}:int,n:bigint>>") for c, v in none.items()})
        else:
            out = by(rows).agg(F.count("*").alias("source_images"), F.count_if("saved").alias("extracted"), (F.count("*") - F.count_if("saved")).alias("failed"))
            for c, v in none.items():
                column = v if v in rows.columns else None
                empty = F.array().cast(f"array<struct<{v}:int,n:bigint>>")
                if column is None:
                    out = out.withColumn(c, empty)
                    continue
                counts = rows.where("saved").groupBy("chunk_id", F.col(column).cast("int").alias(v)).agg(F.count("*").alias("n"))
                counts = by(counts).agg(F.array_sort(F.collect_list(F.struct(v, "n"))).alias(c))
                out = out.join(counts, "chunk_id", "left").withColumn(c, F.coalesce(c, empty))
        return out.select("chunk_id", F.lit(name).alias("folder"), F.lit(batch).cast("string").alias("batch"), "source_images", "extracted", "failed", "ages", "genders")

    def lines(self, number: int | None = None) -> DataFrame:
        """A version's chunks as a table: what sums are merged from, without the chunks' rows."""
        found = self.current(number)
        return self._lines(found.lines) if found.number else self.spark.createDataFrame([], LINES)

    def read(self, number: int | None = None) -> DataFrame:
        """Rows of a version with their chunk_id; an error if it has no chunk.

        Folders of which the version uses all chunks are one scan; rows of the others are looked up in its lines.
        """
        found = self.current(number)
        if not found.writes:
            raise ValueError(f"no chunks under {self.path}")
        whole = [f for f, w in found.writes.items() if w["chunks"] == w["used"]]
        part = [f for f in found.writes if f not in set(whole)]
        scan = lambda folders: self.spark.read.option("basePath", f"{self.path}/data").parquet(*(f"{self.path}/data/{f}" for f in folders))
        out = scan(whole).drop("write") if whole else None
        if part:
            rows = scan(part)
            used = self._lines(found.lines).select(F.col("chunk_id").alias("_chunk"), F.substring_index("folder", "=", -1).alias("_write"))
            rows = rows.join(used, (F.col("chunk_id") == F.col("_chunk")) & (F.col("write") == F.col("_write")), "left_semi").drop("write")
            out = rows if out is None else out.unionByName(rows)
        return out

    def vacuum(self, keep: int = 2) -> int:
        """Remove versions but for the newest ``keep``, and folders that none of these names; no write may be under way. How many folders of rows went."""
        numbers = self.numbers()
        kept = [self.current(n) for n in numbers[-keep:]]
        used, lines = {f for v in kept for f in v.writes}, {v.lines for v in kept}
        for n in numbers[:-keep]:
            self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(self.file(n)), False)
        for n in self._names("versions"):
            if n.startswith("lines=") and n not in lines:
                self._fs.delete(self._path("versions", n), True)
        gone = [n for n in self._names("data") if n not in used]
        for n in gone:
            self._fs.delete(self._path("data", n), True)
        return len(gone)
