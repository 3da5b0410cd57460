"""L2 norm, unit vectors and cosine over ARRAY columns, in double precision."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def usable_norm(n: Column) -> Column:
    """True for a positive norm. NaN > 0 is true in Spark, so NaN is tested by itself."""
    return F.coalesce((n > 0) & ~F.isnan(n), F.lit(False))


def l2_normalize(v: Column) -> Column:
    """Unit vector in doubles; null where the norm is zero, NaN or null."""
    n = l2_norm(v)
    return F.when(usable_norm(n), F.transform(v, lambda x: x.cast("double") / n))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where either has no usable norm."""
    na, nb = l2_norm(a), l2_norm(b)
    dot = _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    return F.when(usable_norm(na) & usable_norm(nb), dot / (na * nb))


def l2_norm_batch(v: Column) -> Column:
    """l2_norm over whole Arrow batches, for wide vectors: one NumPy pass where all lengths agree."""
    import numpy as np

    @F.pandas_udf("double")
    def norm(batch: pd.Series) -> pd.Series:
        full = batch[batch.notna()]
        sizes = full.map(len).unique()
        if len(sizes) == 1 and sizes[0]:
            values = np.sqrt(np.square(np.stack(full.to_numpy()).astype(np.float64)).sum(1))
        else:
            values = [float(np.sqrt(np.square(np.asarray(x, np.float64)).sum())) for x in full]
        return pd.Series(values, index=full.index, dtype="float64").reindex(batch.index)

    return norm(v)
