"""Near-duplicate classes: BagMinHash signatures of word shingle multisets, banded and verified.

A text is the multiset of its runs of five words. Its similarity to another is the weighted Jaccard
coefficient of the counts. Each distinct shingle runs Poisson processes over its weight: one of rate 1
over the first unit, one of rate 1 over the second, 2 over the next two, 4 over the next four and so on.
A point of a process falls on a unit and counts if the shingle's weight covers it. Each point belongs to
one place of the signature, and each place keeps its earliest point. Two places are equal with the
probability of the similarity. Processes stop at the latest place of their text, so that long texts cost
little more than their number of shingles.

Whole copies are one entry from the start. Entries that share a band are compared with the bucket's
leader, the entry with the most company, and not with each other. Of buckets whose entries then still belong to
different classes, all pairs of different classes are left. An exact bound rules out most of them without a look at
their texts: only shingles that several classes have can be in common, two similar texts share one of their
rarest, and what their rarest share and the rest of them weigh is the most they can have in common. Entries meet in
a shingle only if what both have left from it on weighs enough, so entries of one large group with too many shingles
of their own don't meet. The pairs that remain are all compared, so no link that joins two classes is lost.

On request (`exact` false) such buckets are cut by the next band instead, and again by the one after, until they are few,
as in a forest of prefix trees; at each depth all are compared with one leader from outside the largest class. That
bounds the comparisons for each entry and band and loses links of two entries outside the largest class of a bucket of
more than FEW entries that share no longer run of bands and are in no other way connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revaudit.llm.common import slices
from revaudit.llm.components import components
from revaudit.llm.words import Words, digests, lists, mixed, salted, shingles, split_words
from revaudit.operators.scratch import settle

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5

#: Unless links are exact: entries of a bucket that may all be compared; a larger one is cut by the next band.
FEW = 16
#: Unless links are exact: bands that name the smallest buckets.
DEPTH = 5
#: Weights of more than this many shingles are in bins of one part in as many, lower ones in bins of their own.
WEIGHT_BINS = 25
#: What rows of prefixes have in common that are in reach of each other.
ROLE_KEYS = ["shingle", "asks", "bin_a", "bin_b"]
#: Entries compared with one copy of a leader's text.
LEADER_PARTNERS = 256

_SIGNATURE = "doc_id long, mark long, digest long, check long, weight long, bands array<long>"
_UNIT = float(1 << 53)


def weighted_shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, hash, weight and a key of (text, hash) for each distinct shingle of each text, by key."""
    text, shingle = shingles(words, n)
    key, first, weight = np.unique(salted(shingle, text), return_index=True, return_counts=True)
    return text[first], shingle[first], weight, key


def bag_min_hash(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, places: int) -> np.ndarray:
    """The signatures of all texts, one row each; the places of a text without shingles are all ones."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    earliest = np.full(texts * places, none)
    doc, seed, rate, low, top = [], [], [], [], []
    level, begin = 0, 0
    while True:
        has = np.flatnonzero(weight > begin)
        if not len(has):
            break
        size = 1 if level == 0 else 1 << (level - 1)
        doc.append(text[has])
        seed.append(mixed(shingle[has] + np.uint64((level + 1) * 0xD1B54A32D192ED03 % (1 << 64))))
        rate.append(np.full(len(has), float(size)))
        low.append(np.full(len(has), begin))
        top.append(weight[has])
        level, begin = level + 1, begin + size
    if not doc:
        return earliest.reshape(texts, places)
    doc, seed, rate, low, top = (np.concatenate(x) for x in (doc, seed, rate, low, top))
    time, count = np.zeros(len(doc)), np.zeros(len(doc), np.uint64)
    while len(doc):
        ahead = int(min(64, max(1, 100_000 // len(doc))))
        at = count[:, None] + np.arange(1, ahead + 1, dtype=np.uint64)
        one = mixed(seed[:, None] + at * np.uint64(0x9E3779B97F4A7C15))
        two = mixed(one ^ np.uint64(0xA0761D6478BD642F))
        gap = -np.log(((one >> np.uint64(11)).astype(np.float64) + 0.5) / _UNIT) / rate[:, None]
        times = time[:, None] + np.cumsum(gap, axis=1)
        unit = low[:, None] + ((two >> np.uint64(40)).astype(np.float64) / (1 << 24) * rate[:, None]).astype(np.int64)
        place = ((two & np.uint64(0xFFFFFFFF)) * np.uint64(places)) >> np.uint64(32)
        # the time's leading bits order the points; the low bits name the point
        value = (times.view(np.uint64) & np.uint64(0xFFFFFFFFFFFF0000)) | (one & np.uint64(0xFFFF))
        counts = unit < top[:, None]
        index = doc[:, None] * places + place.astype(np.int64)
        np.minimum.at(earliest, index[counts], value[counts])
        latest = earliest.reshape(texts, places).max(axis=1)
        more = value[:, -1] < latest[doc]
        doc, seed, rate, low, top = doc[more], seed[more], rate[more], low[more], top[more]
        time, count = times[more, -1], count[more] + np.uint64(ahead)
    return earliest.reshape(texts, places)


def _signature_batches(n: int, bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = split_words(part.column("text"))
                text, shingle, weight, _ = weighted_shingles(words, n)
                total = np.bincount(text, weight, minlength=part.num_rows).astype(np.int64)
                signature = bag_min_hash(text, shingle, weight, part.num_rows, bands * rows)
                keys = np.zeros((part.num_rows, bands), np.uint64)
                for row in range(rows):
                    keys = mixed(keys + signature[:, row::rows] + np.uint64(row + 1))
                keys = mixed(keys + np.arange(bands, dtype=np.uint64))
                some = total > 0
                digest, check = digests(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("mark"),
                        pa.array(digest),
                        pa.array(check),
                        pa.array(total),
                        lists(keys[some].view(np.int64).ravel(), some * bands, pa.int64()),
                    ],
                    ["doc_id", "mark", "digest", "check", "weight", "bands"],
                )

    return work


def _similarity_batches(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_b", most=2 << 20):
                sides = [weighted_shingles(split_words(part.column(c)), n) for c in ("text_a", "text_b")]
                (text, _, one, key), (_, _, two, other) = sides
                _, i, j = np.intersect1d(key, other, assume_unique=True, return_indices=True)
                common = np.bincount(text[i], np.minimum(one[i], two[j]), minlength=part.num_rows)
                total = sum(np.bincount(x[0], x[2], minlength=part.num_rows) for x in sides)
                similarity = common / np.maximum(total - common, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(similarity)], ["a", "b", "similarity"]
                )

    return work


def similarities(pairs: DataFrame, texts: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """a, b, similarity of distinct pairs; `texts` has entry and text. a may occur in very many pairs.

    Such an a's text is joined to parts of its pairs, as many as it has partners for.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_PARTNERS).cast("int").alias("parts"))
    led = texts.withColumnRenamed("entry", "a").withColumnRenamed("text", "text_a").join(parts, "a")
    led = led.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    dealt = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    other = texts.withColumnRenamed("entry", "b").withColumnRenamed("text", "text_b")
    both = dealt.join(led, ["a", "part"]).join(other, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_similarity_batches(n), "a long, b long, similarity double")


def _shingle_batches(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 20):
                text, shingle, weight, _ = weighted_shingles(split_words(part.column("text")), n)
                entry = part.column("entry").to_numpy()[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), pa.array(entry), pa.array(weight, pa.int64())],
                    ["shingle", "entry", "weight"],
                )

    return work


def shared_weights(texts: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """entry, alone: the weight of the shingles that no other of the texts has; entries without any are left out."""
    rows = texts.mapInArrow(_shingle_batches(n), "shingle long, entry long, weight long")
    alone = rows.groupBy("shingle").agg(
        F.min("entry").alias("entry"), F.max("entry").alias("last"), F.max("weight").alias("weight")
    )
    return alone.where("entry = last").groupBy("entry").agg(F.sum("weight").alias("alone"))


def _comparable(threshold: float):
    """Whether the weights, and the parts of them that may be in common, leave the similarity possible.

    The shingles in common weigh at most `shared` of either; all together weigh the rest as well.
    """
    common = F.least("shared_a", "shared_b")
    return common >= threshold * (F.col("weight_a") + F.col("weight_b") - common)


def _possible(threshold: float):
    """Whether the distances from one leader leave the similarity possible; null if one is not known."""
    return F.coalesce(F.abs(F.col("far_a") - F.col("far")) <= 1 - threshold + 1e-9, F.lit(True))


def _forest_pairs(open_rows: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """a, b: the pairs of different classes that a bucket's entries are compared in, once it is cut to few.

    `open_rows` has band, entry, weight, shared, far, label and rest: the entries of mixed buckets. A bucket of depth d is
    named by a band and the d - 1 after it. In one of few entries all that are outside the largest class ask; in a
    larger one a single one of them does, and the bucket is cut again.
    """
    every = F.col("bands")
    run = lambda i, d: F.xxhash64(F.lit(d), *(every[(i + k) % BANDS] for k in range(d)))
    named = F.array(*(F.struct(every[i].alias("band"), F.array(*(run(i, d) for d in range(1, DEPTH + 1))).alias("keys")) for i in range(BANDS)))
    keys = entries.join(open_rows.select("entry").distinct(), "entry").select("entry", F.explode(named).alias("x"))
    rows = open_rows.join(keys.select("entry", "x.band", "x.keys"), ["entry", "band"])
    rows = settle(rows.select("entry", "weight", "shared", "far", "label", "rest", "keys"), "neardup-runs")
    placed = rows.select("entry", "rest", F.posexplode("keys").alias("depth", "key"), F.col("keys").alias("all_keys"))
    lowest = F.min(F.when(F.col("rest"), F.struct(F.xxhash64("entry", "key").alias("h"), "entry")))
    sizes = placed.groupBy("key").agg(F.count("*").alias("n"), lowest.alias("low"))
    sizes = settle(sizes.where("n > 1 and low is not null").select("key", "n", F.col("low.entry").alias("leader")), "neardup-runs-sizes")
    above = F.when(F.col("depth") > 0, F.col("keys")[F.col("depth") - 1])
    placed = rows.select("*", F.posexplode("keys").alias("depth", "key")).withColumn("above", above).drop("keys", "depth")
    large = sizes.where(F.col("n") > FEW).select(F.col("key").alias("above"))
    cut = placed.where("above is null").unionByName(placed.join(large, "above", "left_semi").select(*placed.columns))
    cut = settle(cut.drop("above").join(sizes, "key"), "neardup-runs-cut")
    asks = F.col("rest") & ((F.col("n") <= FEW) | (F.col("leader") == F.col("entry")))
    asking = cut.where(asks).select(
        "key", F.col("entry").alias("a"), F.col("weight").alias("weight_a"), F.col("shared").alias("shared_a"),
        F.col("label").alias("other"), F.col("far").alias("far_a"),
    )
    asked = cut.withColumnRenamed("weight", "weight_b").withColumnRenamed("shared", "shared_b")
    return (
        asking.join(asked, "key")
        .where((F.col("other") != F.col("label")) & _possible(threshold) & _comparable(threshold))
        .select(F.least("a", "entry").alias("a"), F.greatest("a", "entry").alias("b"))
        .distinct()
    )


def _roles(ranked: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The prefixes' rows as those of the lighter and of the heavier entry of a pair; they meet in ROLE_KEYS.

    Where two similar entries first share a shingle, neither has less left than both together must have in common. So each
    row has a greatest weight of the other entry (its reach). Both sides name the bins of the weights they allow: rows out
    of each other's reach don't meet, but for those at the edge of a bin. Of two entries one at least asks, as those
    that don't are of one class, the shingle's largest.
    """
    reach = (1 + threshold) / threshold * (F.col("left") + 1e-6) - F.col("weight")
    rows = ranked.withColumn("reach", reach)
    bin_of = lambda x: F.floor(WEIGHT_BINS * F.log1p(x / WEIGHT_BINS))
    own = bin_of(F.col("weight"))
    named = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("label", "weight", "part", "left", "reach")]
    light = rows.where("reach >= weight").select(
        "shingle", "asks", F.col("entry").alias("a"), *named("a"), own.alias("bin_a"),
        F.explode(F.sequence(own, bin_of(F.col("reach")))).alias("bin_b"),
    )
    lowest, highest = bin_of(threshold * F.col("weight") - 1e-5), bin_of(F.least("weight", "reach"))
    met_by = F.when(F.col("asks"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    heavy = rows.withColumn("asks", F.explode(met_by)).select(
        "shingle", "asks", F.col("entry").alias("b"), *named("b"), own.alias("bin_b"),
        F.explode(F.sequence(lowest, highest)).alias("bin_a"),
    )
    return light, heavy


def _shingle_pairs(rest: DataFrame, texts: DataFrame, threshold: float, n: int) -> DataFrame:
    """a, b: the pairs of entries of different classes that may reach the threshold; `rest` has entry, label and weight.

    Only shingles that several classes have can be in common. With each entry's in one order, rarest first, two similar
    entries share one of those with which the rest of the entry still weighs the threshold's part of it (its prefix), and
    at the first of them both have enough left for what they must have in common (`_roles`). What they share in reach and
    what comes after bound the weight in common. No pair is left out otherwise.
    """
    held = texts.join(rest.select("entry"), "entry").mapInArrow(_shingle_batches(n), "shingle long, entry long, weight long")
    held = settle(held.withColumnRenamed("weight", "part").join(rest, "entry"), "neardup-shingles")
    counts = held.groupBy("shingle", "label").agg(F.count("*").alias("n")).groupBy("shingle").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("labels")
    )
    counts = counts.where("labels > 1").select("shingle", "n", F.col("top.label").alias("main"))
    upwards = Window.partitionBy("entry").orderBy(F.desc("n"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = held.join(counts, "shingle").withColumn("left", F.sum("part").over(upwards))
    ranked = ranked.where(F.col("left") >= threshold * F.col("weight") - 1e-6)
    ranked = settle(ranked.withColumn("asks", F.col("label") != F.col("main")).drop("main", "n"), "neardup-prefixes")
    light, heavy = _roles(ranked, threshold)
    lighter = (F.col("weight_a") < F.col("weight_b")) | ((F.col("weight_a") == F.col("weight_b")) & (F.col("a") < F.col("b")))
    within = (F.col("weight_b") <= F.col("reach_a")) & (F.col("weight_a") <= F.col("reach_b"))
    met = light.join(heavy, ROLE_KEYS).where((F.col("label_a") != F.col("label_b")) & lighter & within)
    # the shingles in reach are the first ones that a pair shares: what comes after the last of them bounds the others too
    both = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.sum(F.least("part_a", "part_b")).alias("met"),
        F.min(F.least(F.col("left_a") - F.col("part_a"), F.col("left_b") - F.col("part_b"))).alias("after"),
        F.max(F.col("weight_a") + F.col("weight_b")).alias("total"),
    )
    most = F.col("met") + F.col("after")
    return both.where(most >= threshold * (F.col("total") - most) - 1e-6).select("a", "b")


def entry_links(
    entries: DataFrame, texts: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE_WORDS, exact: bool = True
) -> DataFrame:
    """a, b: verified links that connect the entries whose similarity reaches the threshold and that share a band.

    `entries` has entry, mark, weight and bands; `texts` has doc_id, mark and text, and is read for entries in company
    only. All such entries are connected; without `exact`, all but those that cutting large buckets parts.
    """
    rows = entries.select("entry", "weight", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("company")).where("company > 1")
    members = settle(rows.join(shared, "band"), "neardup-members")
    degrees = members.groupBy("entry").agg(F.sum("company").alias("degree"))
    degrees = settle(degrees, "neardup-degrees")
    plain = texts.select(F.col("doc_id").alias("entry"), "mark", "text")
    company = entries.select("entry", "mark").join(degrees.select("entry"), "entry")
    texts = settle(plain.join(company, ["entry", "mark"]).drop("mark").dropDuplicates(["entry"]), "neardup-texts")
    degrees = settle(degrees.join(shared_weights(texts, n), "entry", "left"), "neardup-degrees")
    shared = F.col("weight") - F.coalesce("alone", F.lit(0))
    members = members.select("band", "entry", "weight").join(degrees, "entry").withColumn("shared", shared)
    # an entry that shares too little of itself is similar to none
    members = settle(members.where(shared >= threshold * F.col("weight")).drop("alone"), "neardup-members")

    def led(candidates: DataFrame) -> DataFrame:
        best = F.max(F.struct("degree", (-F.col("entry")).alias("low"), "weight", "shared")).alias("top")
        return candidates.groupBy("band").agg(best).select(
            "band", (-F.col("top.low")).alias("a"), F.col("top.weight").alias("weight_a"), F.col("top.shared").alias("shared_a")
        )

    def compared(pairs: DataFrame) -> DataFrame:
        return settle(similarities(settle(pairs, "neardup-pairs"), texts, n), "neardup-similar")

    leaders = settle(led(members), "neardup-leaders")
    tied = members.join(leaders, "band").where("a <> entry")
    tied = tied.withColumnRenamed("weight", "weight_b").withColumnRenamed("shared", "shared_b")
    tied = tied.where(_comparable(threshold)).select("a", F.col("entry").alias("b")).distinct()
    known = compared(tied)
    links = known.where(F.col("similarity") >= threshold).select("a", "b")
    label = F.coalesce("label", "entry")
    labels = components(links).withColumnRenamed("node", "entry")
    if exact:
        labelled = members.select("band", "entry", "weight").join(labels, "entry", "left").withColumn("label", label)
        several = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        rest = labelled.join(several.select("band"), "band", "left_semi").select("entry", "label", "weight").distinct()
        pairs = _shingle_pairs(settle(rest, "neardup-rest"), texts, threshold, n)
    else:
        near = members.join(leaders, "band").join(known.withColumnRenamed("b", "entry"), ["a", "entry"], "left")
        far = F.when(F.col("a") == F.col("entry"), 0.0).otherwise(1 - F.col("similarity"))
        labelled = near.select("band", "entry", "weight", "shared", "a", far.alias("far")).join(labels, "entry", "left")
        labelled = settle(labelled.withColumn("label", label), "neardup-members")
        sizes = labelled.groupBy("band", "label").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("band").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
        largest = largest.where(F.col("all") > F.col("top.n")).select("band", F.col("top.label").alias("main"))
        open_rows = labelled.where("entry <> a").join(largest, "band").withColumn("rest", F.col("label") != F.col("main"))
        pairs = _forest_pairs(settle(open_rows, "neardup-open"), entries, threshold)
    return links.unionByName(compared(pairs).where(F.col("similarity") >= threshold).select("a", "b"))


def classes(documents: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE_WORDS, exact: bool = True) -> DataFrame:
    """doc_id, class_id, class_size: one row for each row of `documents` (doc_id, text; others are not read).

    class_id is the lowest doc_id of the class: of all documents that chains of links of at least the
    threshold connect. Texts with the same words in the same order are in one class, also null, empty and
    blank ones, which have no words. A text of fewer than n words is one shingle. Rows of one doc_id with different texts
    are one document with all their copies; of its texts the one of lowest hash is compared with others. Rows without
    doc_id have a null class and no size. An empty table gives an empty one. `exact` is that of `entry_links`.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = rows.where("doc_id is not null").withColumn("mark", F.xxhash64("text"))
    signed = settle(named.mapInArrow(_signature_batches(n, BANDS, ROWS), _SIGNATURE), "neardup-signatures")
    groups = signed.groupBy("digest", "check").agg(F.min("doc_id").alias("entry"), F.count("*").alias("copies"))
    groups = settle(groups, "neardup-copies")
    own = signed.where(F.size("bands") > 0).withColumnRenamed("doc_id", "entry")
    entries = own.join(groups.select("digest", "check", "entry"), ["digest", "check", "entry"])
    first = F.min_by(F.struct("mark", "weight", "bands"), "mark").alias("x")
    entries = settle(entries.groupBy("entry").agg(first).select("entry", "x.*"), "neardup-entries")
    labels = components(entry_links(entries, named, threshold, n, exact))
    nodes = groups.select("entry").distinct().join(labels.withColumnRenamed("node", "entry"), "entry", "left")
    # a document of several texts is in the group of each, whose other rows may have a lower id
    classed = groups.join(nodes, "entry").withColumn("class_id", F.coalesce("label", "entry"))
    sizes = classed.groupBy("class_id").agg(F.sum("copies").alias("class_size"))
    classed = settle(classed.select("digest", "check", "class_id").join(sizes, "class_id"), "neardup-classes")
    out = signed.select("doc_id", "digest", "check").join(classed, ["digest", "check"])
    none = F.lit(None).cast("long")
    return out.select("doc_id", "class_id", "class_size").unionByName(
        rows.where("doc_id is null").select("doc_id", none.alias("class_id"), none.alias("class_size"))
    )


def keep_one(documents: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE_WORDS, exact: bool = True) -> DataFrame:
    """The documents without all but the lowest doc_id of each class; rows without doc_id stay."""
    gone = classes(documents, threshold, n, exact).where("doc_id <> class_id").select("doc_id")
    return documents.join(gone.distinct(), "doc_id", "left_anti").select(*documents.columns)
