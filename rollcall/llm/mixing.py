"""Mixing sources to target weights: Efraimidis-Spirakis sampling without replacement, in whole epochs first.

Built-in DataFrame functions only. Each document gets an exponential key -ln(u) / w, u being a uniform
number from a hash of its doc_id, its text and its number among equal rows, and w a quality weight between
``LEAST_WEIGHT`` and 1: the share of letters among its non-space characters, less for texts of fewer than
``FULL_WORDS`` words. A source first gives every document floor(target / size) times
(complete epochs); the rest of its target is filled with documents in key order, by prefix sums of
their sizes, up to the document that comes nearest to the target.

The prefix sums never put a source into one task: keys are dealt into bins of about ``BIN_ROWS``
documents by 1 - exp(-LEAST_WEIGHT * key), which no weight makes denser than 2 / bins; bins are summed,
the small table of sums is accumulated, and rows are only ordered within their bin. Rows that share doc_id
(or have none) differ by text, and rows equal in both are numbered, by a count for each written part and
an order inside it. So no key gathers in a bin, and reruns agree whatever the order or the partitioning.

Null text has size 0; a null source is a source of its own, in last place; documents of size 0 are never
taken. Of equal rows it is open which is taken, not how many. An empty table gives no rows. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Weights of the sources in code point order, repeating; a source gives at most so many times its size.
CYCLE, MOST_EPOCHS = 3, 3
#: Least quality weight, words from which a text has its whole weight, documents of one bin, seed of the uniform numbers.
LEAST_WEIGHT, FULL_WORDS, BIN_ROWS, SEED = 0.5, 20, 2000, 42


def word_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """LEAST_WEIGHT to 1: share of letters (A-Z, a-z and all beyond ASCII) among non-space characters, times size / FULL_WORDS up to 1."""
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    letters = F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    share = F.try_divide(letters.cast("double"), solid.cast("double")) * F.least(size.cast("double") / FULL_WORDS, F.lit(1.0))
    return F.coalesce(F.lit(LEAST_WEIGHT) + F.lit(1 - LEAST_WEIGHT) * share, F.lit(LEAST_WEIGHT))


def row_hash(key: Column, text: Column) -> Column:
    """MD5 of the text and of the key together, the same for equal rows only."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.md5(text), F.lit("null"))))


def uniform(row: Column, copy: Column, seed: int = SEED) -> Column:
    """A number in (0, 1) from 48 bits of a hash of a row and its number among equal ones."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), row, F.lit(":"), copy.cast("string"))), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 48))


def with_copy_numbers(rows: DataFrame) -> DataFrame:
    """Adds copy: 0, 1, ... among rows with one (source, row). rows: a written table with _part, a number for each part of bounded size.

    Only rows that occur again are counted by part and numbered inside their part.
    """
    counts = rows.groupBy("source", "row", "_part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source", "row").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 1 or before > 0").select(F.col("source").alias("s"), F.col("row").alias("r"), F.col("_part").alias("p"), "before")
    counts = materialize(counts)
    if counts.isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long")).drop("_part")
    joined = rows.join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("row") == F.col("r")) & (F.col("_part") == F.col("p")), "left")
    place = F.row_number().over(Window.partitionBy("source", "row", "_part").orderBy("size")) - 1
    again = joined.where("before is not null").withColumn("copy", (F.col("before") + place).cast("long"))
    once = joined.where("before is null").withColumn("copy", F.lit(0).cast("long"))
    return once.unionByName(again).drop("_part", "s", "r", "p", "before")


def source_targets(sources: DataFrame) -> DataFrame:
    """Targets for (source, source_size): shares by weight of the total, none above MOST_EPOCHS times its source.

    Re-sharing the excess until nobody is above ends at target = min(cap, level * weight). With sources in
    order of cap / weight, the level once the first k are capped rises with k as long as caps bind and
    falls after that, so the right one is the greatest. One row for each source: small.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", ((F.row_number().over(place) - 1) % CYCLE + 1).cast("double")).withColumn("cap", (F.col("source_size") * MOST_EPOCHS).cast("double"))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum(F.col("source_size").cast("double")).over(Window.partitionBy(F.lit(0)))
    stepped = weighed.withColumn("level", (total - capped) / open_weight)
    level = F.max("level").over(Window.partitionBy(F.lit(0)))
    return stepped.withColumn("low", level).select("source", "source_size", "n_docs", F.coalesce(F.least(F.col("cap"), F.col("low") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """(key, size, source_size, target, taken, source, epochs, text_hash) of every row; taken counts repeats."""
    t = F.col(text).cast("string")
    size = word_size(t)
    rows = docs.select(F.col(key).alias("k"), F.col(source).alias("source"), size.alias("size"), quality_weight(t, size).alias("weight"), row_hash(F.col(key), t).alias("row"), F.xxhash64(t).alias("text_hash"))
    # a part of the written table is a task's rows; a rerun may deal them otherwise, equal rows stay as many
    rows = materialize(rows.withColumn("_part", F.spark_partition_id()))
    rows = materialize(with_copy_numbers(rows))
    rows = rows.withColumn("es_key", -F.ln(uniform(F.col("row"), F.col("copy"), seed)) / F.col("weight"))
    targets = materialize(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))))
    t2 = targets.withColumnRenamed("source", "s")
    bins = F.ceil(F.col("n_docs") / BIN_ROWS)
    dealt = rows.join(t2, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("bin", F.floor(bins * (1 - F.exp(-LEAST_WEIGHT * F.col("es_key")))).cast("long"))
    sums = dealt.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("bin").alias("b"), F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)).alias("bin_before"))
    placed = dealt.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    inside = Window.partitionBy("source", "bin").orderBy("es_key", "row", "copy").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("bin_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    chosen = placed.withColumn("epochs", epochs).withColumn("before", before)
    taken = F.col("epochs") * F.col("size") + F.when((F.col("epochs") < MOST_EPOCHS) & (F.col("before") + F.col("size") / 2 <= rest), F.col("size")).otherwise(F.lit(0))
    return chosen.select(F.col("k").alias(key), "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "epochs", "text_hash")


#: DuckDB SQL of the query over documents.
MIX_SQL = r"""
WITH plain AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')) AS row,
         CAST(length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g')) AS DOUBLE) / nullif(CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS DOUBLE), 0) AS letters
  FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, row) - 1 AS copy FROM plain),
rows AS (
  SELECT *, -ln((CAST(CAST('0x' || substr(md5('42:' || row || ':' || copy), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656.0)
            / coalesce(CAST(0.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * (letters * least(CAST(size AS DOUBLE) / 20, CAST(1 AS DOUBLE))), CAST(0.5 AS DOUBLE)) AS es_key
  FROM numbered),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(source_size * 3 AS DOUBLE) AS cap FROM sources),
stepped AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, coalesce(least(cap, max(level) OVER () * weight), cap) AS target FROM stepped),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.source,
         CAST(coalesce(floor(t.target / nullif(CAST(t.source_size AS DOUBLE), 0)), 0) AS BIGINT) AS epochs,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.es_key, r.row, r.copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN epochs < 3 AND before + size / 2.0 <= target - epochs * source_size THEN size ELSE 0 END AS BIGINT) AS taken,
       source, epochs
FROM placed
"""
