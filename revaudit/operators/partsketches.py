"""Approximate quantiles and distinct counts from sketches stored per part.

One KLL sketch a numeric column and one HLL sketch a counted column, for each group of a part. Sketches
of a few kilobytes stand for any number of rows and are united on demand, so a question about all months
reads no reviews.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch size: the rank error of a quantile is below RANK_ERROR with 99 % confidence at this size.
KLL_SIZE = 400
RANK_ERROR = 0.007

#: Log2 of the registers: the standard error of a distinct count is DISTINCT_ERROR.
HLL_LOG2 = 14
DISTINCT_ERROR = 0.0065


def sketch_parts(
    df: DataFrame, by: Sequence[str], numbers: Sequence[str] = (), counted: Sequence[str] = ()
) -> DataFrame:
    """Per group: ``<column>_kll`` and ``<column>_hll``, all in one scan; nulls and NaN are left out."""
    kll = [
        F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(KLL_SIZE)).alias(f"{c}_kll")
        for c in numbers
    ]
    hll = [F.hll_sketch_agg(F.col(c).cast("string"), HLL_LOG2).alias(f"{c}_hll") for c in counted]
    return df.groupBy(*by).agg(*kll, *hll)


def united(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""
    kll = [F.kll_merge_agg_double(c, F.lit(KLL_SIZE)).alias(c) for c in parts.columns if c.endswith("_kll")]
    hll = [F.hll_union_agg(c).alias(c) for c in parts.columns if c.endswith("_hll")]
    return parts.groupBy(*by).agg(*kll, *hll)


def quantile(column: str, rank: float) -> Column:
    """The value at a share of the ranks; null for a sketch of nothing."""
    sketch = F.col(f"{column}_kll")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def distinct(column: str) -> Column:
    return F.hll_sketch_estimate(f"{column}_hll")
