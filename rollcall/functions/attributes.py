"""Age buckets and labels, defaults for missing attributes, narrow integer types."""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code and label of each age group; -1 is unknown.
AGE_LABELS = {-1: "Unknown", 0: "Young (0-24)", 1: "Adult (25-44)", 2: "Middle-Aged (45-64)", 3: "Senior (65+)"}


def age_group(age: Column) -> Column:
    return F.when(age < 0, -1).when(age < 25, 0).when(age < 45, 1).when(age < 65, 2).when(age >= 65, 3).otherwise(-1).cast("tinyint")


def age_group_label(group: Column, unknown: bool = True) -> Column:
    """Label of a group; null for -1 unless ``unknown``."""
    pairs = [(k, v) for k, v in AGE_LABELS.items() if unknown or k >= 0]
    return F.try_element_at(F.create_map(*(F.lit(x) for x in chain(*pairs))), group.cast("int"))


def with_attr_defaults(df: DataFrame) -> DataFrame:
    """Missing age and gender become -1."""
    return df.withColumn("age", F.coalesce("age", F.lit(-1))).withColumn("gender", F.coalesce("gender", F.lit(-1)))


def cast_attributes(df: DataFrame) -> DataFrame:
    """age SMALLINT, gender TINYINT, age_group TINYINT; a value out of range is an error."""
    return df.withColumn("age", F.col("age").cast("smallint")).withColumn("gender", F.col("gender").cast("tinyint")).withColumn("age_group", F.col("age_group").cast("tinyint"))
