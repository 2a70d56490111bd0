"""Duplicate rows by review id, by text and by all columns, in one scan and one shuffle.

Rows are compared by 256-bit digests, so the shuffle carries 32 bytes instead of a text. Counts
combine on the map side: a key that a third of all rows share costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from revaudit.schema import LONG_TEXT_COLUMNS

BY_ID, BY_TEXT, BY_ALL = "review_id", "text", "all_columns"
ALL_SETS = (BY_ID, BY_TEXT, BY_ALL)
# Reviews of one business with one text; those without a business or text are left out.
BY_BUSINESS = "business_text"


def text_digest(name: str) -> Column:
    return F.unhex(F.sha2(F.col(name), 256))


def _row_digest(df: DataFrame) -> Column:
    """Digest of all columns. JSON keeps column borders and nulls apart; 0.0 equals -0.0."""

    def part(field: T.StructField) -> Column:
        if field.name in LONG_TEXT_COLUMNS:
            return F.sha2(F.col(field.name), 256).alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return (F.col(field.name) + 0.0).alias(field.name)
        return F.col(field.name)

    row = F.struct(*[part(field) for field in df.schema])
    return F.unhex(F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256))


def _business_digest() -> Column:
    both = F.col("business_id").isNotNull() & F.col("text").isNotNull()
    pair = F.concat_ws("|", F.col("business_id").cast("string"), F.hex("by_text"))
    return F.when(both, F.unhex(F.sha2(pair, 256)))


def keyed_reviews(df: DataFrame, sets: Sequence[str] = ALL_SETS) -> DataFrame:
    """One row per review and set: (review_id, duplicate_set, key)."""
    keys = {
        BY_ID: lambda: F.col("review_id").cast("string").cast("binary"),
        BY_TEXT: lambda: text_digest("text"),
        BY_ALL: lambda: _row_digest(df),
    }
    # The keys are columns first, so that a text is digested once for all sets that use it.
    kept = ["review_id", *(["business_id", "text"] if BY_BUSINESS in sets else [])]
    plain = [name for name in sets if name != BY_BUSINESS]
    keyed = df.select(*kept, *[keys[name]().alias(f"by_{name}") for name in plain])
    if BY_BUSINESS in sets:
        keyed = keyed.withColumn(f"by_{BY_BUSINESS}", _business_digest())
    cells = [part for name in sets for part in (F.lit(name), F.col(f"by_{name}"))]
    rows = keyed.select(
        "review_id", F.stack(F.lit(len(sets)), *cells).alias("duplicate_set", "key")
    )
    return rows.filter((F.col("duplicate_set") != BY_BUSINESS) | F.col("key").isNotNull())


def _groups(keyed: DataFrame) -> DataFrame:
    """Keys of more than one row and their number of rows; null equals null."""
    return (
        keyed.groupBy("duplicate_set", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def duplicate_groups(df: DataFrame, sets: Sequence[str] = ALL_SETS) -> DataFrame:
    """Groups of more than one row and their size."""
    return _groups(keyed_reviews(df, sets))


def _members(name: str) -> Column:
    inside = F.when(F.col("duplicate_set") == name, F.col("rows"))
    return F.coalesce(F.sum(inside), F.lit(0)).cast("bigint")


def _counted(groups: DataFrame) -> DataFrame:
    return groups.agg(
        _members(BY_ID).alias("duplicate_review_ids"),
        _members(BY_TEXT).alias("duplicate_texts"),
        _members(BY_ALL).alias("exact_duplicates"),
        F.count_if(F.col("duplicate_set") == BY_BUSINESS).alias("repeated_groups"),
    )


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: all members of duplicate groups, by id, by text and by all columns."""
    return _counted(duplicate_groups(df)).drop("repeated_groups")


def _lowest_ids(keyed: DataFrame, groups: DataFrame, first: int) -> DataFrame:
    """The lowest ids among the members of each set's groups.

    Keys are shuffled once more and not sorted by id before they are known to repeat; the rank
    limit is applied in every task before the ranks are put together.
    """
    by_id = Window.partitionBy("duplicate_set").orderBy(F.col("review_id").asc_nulls_last())
    wanted = groups.select(F.col("duplicate_set").alias("set"), F.col("key").alias("group_key"))
    same = (F.col("duplicate_set") == F.col("set")) & F.col("key").eqNullSafe(F.col("group_key"))
    return (
        keyed.join(wanted, same, "left_semi")
        .withColumn("position", F.row_number().over(by_id))
        .filter(F.col("position") <= first)
        .select("duplicate_set", "position", "review_id")
    )


def duplicate_rows(df: DataFrame, first: int = 10) -> DataFrame:
    """The lowest ``first`` review ids among the members of each set's duplicate groups."""
    keyed = keyed_reviews(df)
    return _lowest_ids(keyed, _groups(keyed), first)


def duplicate_report(keyed: DataFrame, first: int = 10) -> DataFrame:
    """One row: the counts, the number of repeated (business, text) groups, and the lowest ids.

    ``keyed`` comes from ``keyed_reviews``; hand in a stored one, and texts are digested once.
    """
    groups = _groups(keyed)
    ids = F.sort_array(F.collect_list(F.struct("position", "review_id")))
    samples = _lowest_ids(keyed, groups.filter(F.col("duplicate_set") != BY_BUSINESS), first)
    listed = samples.groupBy("duplicate_set").agg(
        F.transform(ids, lambda x: x["review_id"]).alias("ids")
    )
    named = listed.agg(F.map_from_entries(F.collect_list(F.struct("duplicate_set", "ids"))).alias("m"))
    held = _counted(groups).withColumn("samples", named.scalar())

    def of(name: str) -> Column:
        return F.coalesce(F.try_element_at("samples", F.lit(name)), F.array().cast(dict(held.dtypes)["samples"].removeprefix("map<string,")[:-1]))

    return held.select(
        "duplicate_review_ids", "duplicate_texts", "exact_duplicates", "repeated_groups",
        of(BY_ID).alias("review_id_sample"), of(BY_TEXT).alias("text_sample"),
        of(BY_ALL).alias("exact_sample"),
    )


def repeated_reviews(df: DataFrame) -> DataFrame:
    """One row: how many (business, text) groups hold more than one review."""
    return (
        df.filter(F.col("business_id").isNotNull() & F.col("text").isNotNull())
        .groupBy("business_id", text_digest("text").alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.count_if(F.col("rows") > 1).alias("repeated_groups"))
    )
