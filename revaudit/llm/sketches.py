"""Document fingerprints: bottom-k sketches of word shingle hashes, as sorted arrays.

The k smallest distinct hashes of a text's shingles. Sketches of parts merge into the sketch of the
whole set of shingles, and two sketches estimate resemblance and containment. Everything is made of
array functions on one row, so a text never meets others in a task, and no row leaves its partition
unless the next document is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.llm.common import words_of
from revaudit.operators.scratch import settle

SHINGLE_WORDS = 5
SKETCH_SIZE = 128

#: Documents whose ids share all but these lowest bits are ordered together: at most 128.
_GROUP_BITS = 7
_SIGN = -(1 << 63)


def _group(doc_id: Column) -> Column:
    """The leading bits of an id, as a number from 0 that rises with the id."""
    return F.shiftrightunsigned(doc_id.bitwiseXOR(F.lit(_SIGN)), _GROUP_BITS)


def shingle_hashes(text: Column, words: int = SHINGLE_WORDS) -> Column:
    """The hash of every run of that many words; a shorter text with words is one shingle.

    A null, empty or blank text has none. Words are hashed once; a shingle's hash is that of its words'.
    """
    hashed = F.transform(words_of(text), lambda w: F.xxhash64(w))


    def of(h: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(h) - words)
        whole = F.transform(every, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
        none = F.array().cast("array<long>")
        return F.when(F.size(h) == 0, none).when(F.size(h) < words, F.array(F.xxhash64(h))).otherwise(whole)

    return _let(hashed, of)


def sketch(text: Column, size: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> Column:
    """The bottom-k sketch of a text: at most `size` hashes in ascending order."""
    return bottom(shingle_hashes(text, words), size)


def bottom(hashes: Column, size: int = SKETCH_SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merge(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """The sketch of the union of two sets of shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_all(parts: DataFrame, keys: list[str], column: str = "sketch", size: int = SKETCH_SIZE) -> DataFrame:
    """The sketch of each key's parts: distinct hashes are counted once and only the k lowest of each key and task
    go on, so a key with very many parts moves little."""
    hashes = parts.select(*keys, F.explode(column).alias("_hash")).distinct()
    lowest = Window.partitionBy(*keys).orderBy("_hash")
    kept = hashes.withColumn("_rank", F.row_number().over(lowest)).where(F.col("_rank") <= size)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def _let(value: Column, use) -> Column:
    """An expression of a value that is computed once a row, also where `use` names it in a lambda."""
    return F.transform(F.array(value), use)[0]


def _resemblance(union: Column, both: Column) -> Column:
    common = _let(F.element_at(union, -1), lambda most: F.size(F.filter(both, lambda x: x <= most)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def resemblance(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated Jaccard similarity of the shingle sets: the share of both in the union's sketch.

    Exact while the union has at most `size` shingles. Two empty sets are equal: 1.
    """
    pair = F.struct(merge(a, b, size).alias("union"), F.array_intersect(a, b).alias("both"))
    return _let(pair, lambda p: _resemblance(p["union"], p["both"]))


def distinct_shingles(s: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles; exact below `size`."""
    span = F.lit(float(1 << 64))
    share = (F.element_at(s, size).cast("double") + F.lit(float(1 << 63))) / span
    return F.when(F.size(s) < size, F.size(s).cast("double")).otherwise((size - 1) / share)


def containment(a: Column, b: Column, size: int = SKETCH_SIZE) -> Column:
    """Estimated share of a's shingles that b has too, 0 to 1; 1 if a has none."""
    own = distinct_shingles(a, size)
    pair = F.struct(merge(a, b, size).alias("union"), F.array_intersect(a, b).alias("both"), own.alias("own"))

    def share(p: Column) -> Column:
        common = _resemblance(p["union"], p["both"]) * distinct_shingles(p["union"], size)
        return F.when(p["own"] == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / p["own"]))

    return _let(pair, share)


def as_text(s: Column) -> Column:
    """A sketch as one string: its hashes in hexadecimal digits, joined by commas."""
    return F.array_join(F.transform(s, lambda x: F.lower(F.hex(x))), ",")


def _next_ids(ids: DataFrame, lowest: int, highest: int) -> DataFrame:
    """group, next_id: the first id beyond each group of ids, null for the last group.

    Groups are ordered inside groups of 1024 groups, these inside theirs and so on, so that no task
    orders more than 1024 rows.
    """
    shift, lowest, highest = 10, lowest - _SIGN, highest - _SIGN
    tops = settle(ids.groupBy("group").agg(F.min("doc_id").alias("first")), "sketch-groups")
    levels = [tops]
    while (lowest >> (_GROUP_BITS + shift)) != (highest >> (_GROUP_BITS + shift)):
        upper = levels[-1].groupBy(F.shiftright("group", 10).alias("group")).agg(F.min("first").alias("first"))
        levels.append(settle(upper, "sketch-groups"))
        shift += 10
    beyond = None
    for level in reversed(levels):
        order = Window.partitionBy("upper").orderBy("group")
        own = level.withColumn("upper", F.shiftright("group", 10)).withColumn("next_id", F.lead("first").over(order))
        if beyond is not None:
            own = own.join(beyond.select(F.col("group").alias("upper"), F.col("next_id").alias("_next")), "upper", "left")
            own = own.withColumn("next_id", F.coalesce("next_id", "_next"))
        beyond = own.select("group", "next_id")
    return beyond


def with_next(documents: DataFrame) -> DataFrame:
    """doc_id, text, next_text and whether the next is in another group of ids (`far`).

    The next document has the next higher id; after the last comes the first, which may be itself.
    Rows of one id follow each other in order of their text. A row without an id has itself as next.
    Texts are shuffled once, by groups of at most 128 neighbouring ids; only the first text of each
    group goes to the group before it.
    """
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    ids = base.where("doc_id is not null").select("doc_id", _group(F.col("doc_id")).alias("group"))
    lowest, highest = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    nothing = base.where("doc_id is null").select("doc_id", "text", F.col("text").alias("next_text"), F.lit(True).alias("far"))
    if lowest is None:
        return nothing.withColumn("group", F.lit(None).cast("long"))
    after = _next_ids(ids, lowest, highest)
    grouped = (
        base.where("doc_id is not null").withColumn("group", _group(F.col("doc_id"))).repartition("group")
    )
    order = Window.partitionBy("group").orderBy("doc_id", "text")
    firsts = (
        grouped.withColumn("_row", F.row_number().over(order)).where("_row = 1").select("doc_id", F.col("text").alias("_text"))
    )
    borders = (
        after.withColumn("doc_id", F.coalesce("next_id", F.lit(lowest)))
        .join(firsts, "doc_id")
        .select(F.col("group"), "_text")
    )
    return (
        grouped.withColumn("next_text", F.lead("text").over(order))
        .join(borders, "group")
        .select(
            "doc_id", "text", F.coalesce("next_text", "_text").alias("next_text"),
            F.col("next_text").isNull().alias("far"), "group",
        )
        .unionByName(nothing.withColumn("group", F.lit(None).cast("long")))
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last floor(n / 4) characters replaced by the first as many of the next."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(next_text, F.lit(1), quarter))


def compare_with_edit(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    One row for each row of `documents` (doc_id, text; other columns are not read). A null text counts
    as empty; empty texts have the empty fingerprint and resemble each other fully, others not at all.
    """
    pairs = with_next(documents).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    order = Window.partitionBy("group").orderBy("doc_id", "text")
    known = pairs.where("group is not null")
    sketched = known.select(
        "group", "doc_id", "text", "edited",
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("changed"),
        F.when(F.col("far"), sketch(F.col("next_text"))).alias("border"),
    ).withColumn("next", F.coalesce("border", F.lead("own").over(order)))
    lone = pairs.where("group is null").select(
        "group", "doc_id", "text", "edited",
        sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("changed"),
        F.lit(None).cast("array<long>").alias("border"), sketch(F.col("text")).alias("next"),
    )
    return sketched.unionByName(lone).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed")).alias("near_edited"),
        resemblance(F.col("own"), F.col("next")).alias("near_next"),
        distinct_shingles(F.col("own")).alias("distinct_shingles"),
        containment(F.col("own"), F.col("changed")).alias("contained_in_edited"),
    )
