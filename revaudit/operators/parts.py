"""Reports that grow by parts: mergeable state per part, added up when a report is asked for.

A part is a stored batch of reviews. ``part_state`` reads only that part and returns one row for each
section and key: counts, range, mean and the sums of squared and cubed deviations. ``merged`` adds the
states of all parts up by the parallel formula for moments, so that a new part never reads an old one.
Each part's state lies in a folder of its own, named by the part: writing a part again replaces it,
so a batch that is replayed counts once.

Sections: ``column`` has a key for each column (validation of ranges and nulls), ``rating`` one for
each rating, the category columns, ``month`` and ``business`` one for each value, over the ratings.
State is as large as the number of different keys; it is grouped and joined, never collected.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from revaudit.functions.stats import percent_of
from revaudit.operators.quantiles import quantiles_of_counts
from revaudit.operators.scratch import settle
from revaudit.schema import CATEGORY_COLUMNS, CRITICAL_COLUMNS
from revaudit.settings import Settings

#: Schema of a part's state.
STATE = (
    "section string, key string, rows bigint, n bigint, bad bigint, low double, high double,"
    " mean double, m2 double, m3 double, part string"
)


def _cell(section: str, key: Column, value: Column, known: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"), key.alias("key"), value.cast("double").alias("value"),
        known.alias("known"), F.coalesce(bad, F.lit(False)).alias("bad"),
    )


def _broken(name: str, settings: Settings) -> Column:
    """Where a value breaks the rule of its column; columns without a rule have none."""
    value = F.col(f"`{name}`")
    rules = {
        "rating": lambda: (value < settings.rating_low) | (value > settings.rating_high),
        "text_length": lambda: value == 0,
        "useful_votes": lambda: value < 0,
    }
    return rules[name]() if name in rules else F.lit(False)


def _cells(df: DataFrame, settings: Settings) -> list[Column]:
    """What a row adds to: one cell for each section that the table has the column for."""
    no, none = F.lit(False), F.lit(None).cast("double")
    cells = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        value = column if isinstance(field.dataType, T.NumericType) else none
        broken = _broken(field.name, settings)
        cells.append(_cell("column", F.lit(field.name), value, column.isNotNull(), broken))
    if "rating" in df.columns:
        rating = F.col("rating").cast("double")
        keys = {"rating": rating.cast("string")}
        keys |= {c: F.col(c).cast("string") for c in CATEGORY_COLUMNS if c in df.columns}
        if "date" in df.columns:
            keys["month"] = F.date_format(F.col("date").cast("date"), "yyyy-MM")
        if "business_id" in df.columns:
            keys["business"] = F.col("business_id").cast("string")
        cells += [_cell(s, key, rating, rating.isNotNull(), no) for s, key in keys.items()]
    return cells


def part_state(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mergeable state of one part: one scan, one shuffle of sums made in each task."""
    value, known = F.col("value"), F.count("value")
    spread = F.coalesce(F.var_pop(value) * known, F.lit(0.0))
    return (
        df.select(F.inline(F.array(*_cells(df, settings))))
        .groupBy("section", "key")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("known").alias("n"),
            F.count_if("bad").alias("bad"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.avg(value).alias("mean"),
            spread.alias("m2"),
            # A constant column has no skewness; its third sum is 0.
            F.when(spread > 0, F.skewness(value) * F.pow(spread, 1.5) / F.sqrt(known))
            .otherwise(0.0)
            .alias("m3"),
        )
    )


def add_part(df: DataFrame, path: str, part: str, settings: Settings = Settings()) -> None:
    """Store the state of a part below ``path``; the same part again replaces its state."""
    part_state(df, settings).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def stored_states(spark: SparkSession, path: str) -> DataFrame:
    """The states of all parts below ``path``; none if no part is there yet."""
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)


def merged(states: DataFrame) -> DataFrame:
    """Add the states of all parts up: one row for each section and key.

    The joint mean comes first, by a window with the same keys as the grouping after it, so both take
    one shuffle. A window holds one row a part.
    """
    own = F.when(F.col("mean").isNotNull(), F.col("n")).otherwise(0)
    apart = F.col("mean") - F.col("joint")
    return (
        _with_joint_mean(states, own)
        .groupBy("section", "key")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("n").alias("n"),
            F.sum("bad").alias("bad"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.max("joint").alias("mean"),
            F.sum(F.col("m2") + F.coalesce(own * apart * apart, F.lit(0.0))).alias("m2"),
            F.sum(
                F.col("m3")
                + F.coalesce(3 * F.col("m2") * apart + own * apart * apart * apart, F.lit(0.0))
            ).alias("m3"),
        )
    )


def _with_joint_mean(states: DataFrame, own: Column) -> DataFrame:
    """Add the mean over all parts of a key to each of its states."""
    whole = Window.partitionBy("section", "key")
    total = F.sum(own).over(whole)
    return states.withColumn(
        "joint", F.sum(F.col("mean") * own).over(whole) / F.nullif(total, F.lit(0))
    )


def _deviation() -> Column:
    """The sample deviation; null below two values."""
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))


def _skewness() -> Column:
    n = F.col("n").cast("double")
    plain = F.sqrt(n) * F.col("m3") / F.pow("m2", 1.5)
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n < 3, None).when(F.col("m2") == 0, 0.0).otherwise(plain * factor)


def _section(state: DataFrame, section: str) -> DataFrame:
    return state.filter(F.col("section") == section)


def column_checks(state: DataFrame) -> DataFrame:
    """Per column: rows, nulls and their share, range, mean, rule-breaking rows (V2 to V5)."""
    missing = F.col("rows") - F.col("n")
    return _section(state, "column").select(
        F.col("key").alias("column"),
        F.col("rows").alias("rows"),
        missing.alias("missing_count"),
        F.bround(percent_of(missing, F.col("rows")), 2).alias("missing_percentage"),
        F.col("key").isin(*CRITICAL_COLUMNS).alias("is_critical"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        "mean",
        F.col("bad").alias("broken_count"),
        (F.col("bad") == 0).alias("valid"),
    )


def _known_ratings(state: DataFrame) -> DataFrame:
    known = _section(state, "rating").filter(F.col("key").isNotNull())
    return known.select(F.col("key").cast("double").alias("rating"), "rows")


def rating_shares(state: DataFrame) -> DataFrame:
    """The share of each rating among the known ones (F1)."""
    ratings = _known_ratings(state)
    total = ratings.agg(F.sum("rows").alias("n")).scalar()
    return ratings.select("rating", (F.col("rows") / total).alias("share"))


def rating_moments(state: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row: mean, median, deviation and skewness of the ratings, and the shares of all rows (F2)."""
    ratings = settle(
        _known_ratings(state).select(
            F.lit("rating").alias("name"), F.col("rating").alias("value"), F.col("rows").alias("n")
        ),
        "rating-counts",
    )
    middle = quantiles_of_counts(ratings, {"rating": [0.5]})["rating"][0]
    value = F.col("value")
    sides = {
        "positive": value >= settings.positive_from,
        "negative": value <= settings.negative_to,
        "neutral": value == settings.neutral_at,
    }
    counted = ratings.agg(
        *[F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).alias(s) for s, test in sides.items()]
    )
    rows = F.nullif(F.col("rows"), F.lit(0))
    found = counted.select(F.struct("*").alias("sides")).scalar()
    own = _section(state, "column").filter(F.col("key") == "rating").withColumn("sides", found)
    return own.select(
        F.col("mean").alias("mean_rating"),
        F.lit(middle).cast("double").alias("median_rating"),
        _deviation().alias("std_rating"),
        _skewness().alias("skewness"),
        *[(F.col(f"sides.{side}") / rows).alias(f"{side}_ratio") for side in sides],
    )


def category_moments(state: DataFrame, category: str) -> DataFrame:
    """Per value: count, mean and deviation of the rating, percentage of all rows (F4)."""
    groups = _section(state, category)
    total = groups.agg(F.sum("rows").alias("n")).scalar()
    known = F.col("key").isNotNull()
    count = F.when(known, F.col("rows")).otherwise(0)
    return groups.select(
        F.col("key").alias("category"),
        count.alias("count"),
        F.when(known, F.col("mean")).alias("avg_rating"),
        F.when(known, _deviation()).alias("rating_std"),
        percent_of(count, total).alias("percentage"),
    )


def month_moments(state: DataFrame) -> DataFrame:
    """Per month: mean, deviation and number of ratings (F6)."""
    return _section(state, "month").filter(F.col("key").isNotNull()).select(
        F.col("key").alias("month"), F.col("mean").alias("avg_rating"),
        _deviation().alias("rating_std"), F.col("n").alias("count"),
    )


def business_moments(state: DataFrame) -> DataFrame:
    """Per business: mean, deviation and number of ratings (the rating part of D1a)."""
    return _section(state, "business").filter(F.col("key").isNotNull()).select(
        F.col("key").alias("business_id"), F.col("mean").alias("business_avg_rating"),
        _deviation().alias("business_rating_std"), F.col("n").alias("business_review_count"),
    )


def report_stream(
    reviews: DataFrame, path: str, progress_path: str | None = None, settings: Settings = Settings()
) -> StreamingQuery:
    """Store the state of each batch that has arrived; call again for later input.

    Each batch is a part named by its number, so a batch that is run again after a failure replaces
    what it had written. What has been read is noted in ``progress_path``, by default beside the states;
    both belong together, as new notes would number the batches from 0 again.
    """
    progress = progress_path or f"{path.rstrip('/')}-progress"

    def store(batch: DataFrame, number: int) -> None:
        add_part(batch, path, f"b{number:012d}", settings)

    return (
        reviews.writeStream.foreachBatch(store)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
