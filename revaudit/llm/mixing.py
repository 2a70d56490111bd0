"""Mix sources to target weights: exact block quotas, dealt to output shards by a splitting tree.

Each source's documents are put in random order by a hash of their id (their draw) and cut into
blocks along it. A target is met by whole passes over the source and one partial pass: documents in
order up to the first that doesn't fit, then every later one that fits in what is still open. The block draws of all passes are a source's quota. A tree
over the output shards splits the quotas: at each node the left half's share of every source is a
multivariate hypergeometric draw, so shards hold exact counts and no block draw twice. Inside a
shard, rows are ordered by another hash.

Nothing here depends on the order of rows, so reruns agree. The tree and the targets work on one
row per source; documents are only read, summed by cells of the draw, and joined to that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.llm.common import words_of
from revaudit.operators.scratch import settle

#: Most sources that are broadcast; a table with more is joined by shuffles.
BROADCAST_SOURCES = 100_000
#: Sources beyond this many share quotas in the splitting tree, so that its arrays stay bounded.
STRATA = 4096
DOCS_PER_BLOCK = 256
SHARDS = 16
#: Documents of a source that may still fit and are gone through as one list; more are cut down by cells first.
FEW_LEFT = 10_000
#: Words that one task of a shard puts in order; a larger shard is ordered in parts.
WORDS_PER_PART = 4_000_000

_DRAW_BITS = 60
_CELL_BITS = 10
_LEVELS = 3

#: Natural logarithms of 0! to 9!, beyond which Stirling's series holds to 12 digits.
_LOG_FACTORIALS = [
    0.0, 0.0, 0.6931471805599453, 1.791759469228055, 3.1780538303479458,
    4.787491742782046, 6.579251212010101, 8.525161361065415, 10.60460290274525, 12.801827480081469,
]


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def draw(doc_id: Column, seed: int) -> Column:
    """60 hash bits that put a source's documents in random order."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, _DRAW_BITS // 4), 16, 10).cast("long")


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be none of the given ones."""
    held = {c.lower() for c in taken}
    out = []
    for name in names:
        name = "_" + name
        while name in held:
            name = "_" + name
        out.append(name)
    return out


def _join(left: DataFrame, sources: DataFrame, bounded: bool) -> DataFrame:
    """Join the table of sources on `source`, null matching null."""
    (name,) = free_names([*left.columns, *sources.columns], "source")
    right = sources.withColumnRenamed("source", name)
    right = F.broadcast(right) if bounded else right
    return left.join(right, F.col("source").eqNullSafe(F.col(name))).drop(name)


def source_targets(sized: DataFrame) -> DataFrame:
    """source, docs, source_size, target: weights 1, 2, 3 repeating in code point order, null last.

    A target above three times its source's size is cut to that, and the excess goes to the others by
    weight until none is above. With sources in order of size per weight, the level of a source is the share
    of each weight if all before it are cut; it rises while they have to be, so the highest one holds.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    return (
        sized.groupBy("source")
        .agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
        .withColumn("weight", F.pmod(F.row_number().over(by_name) - 1, F.lit(3)).cast("long") + 1)
        .withColumn("most", F.col("source_size") * 3)
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("most_before", F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"))
        .withColumn("weight_on", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("most_before")) / F.col("weight_on"))
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source", "docs", "source_size",
            F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def _cut_draws(sized: DataFrame, sources: DataFrame, bounded: bool) -> DataFrame:
    """source, cut: the highest draw of the partial pass, -1 for none.

    Sizes are summed by the leading bits of the draw; the cell in which the rest of the target runs
    out is looked at again with more bits. Every level sums at most 1024 cells a source.
    """
    at = sources.select("source", "rest", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("used"))
    order = Window.partitionBy("source").orderBy("part")
    for level in range(_LEVELS):
        shift = _DRAW_BITS - _CELL_BITS * (level + 1)
        inside = (
            _join(sized, at, bounded)
            .where(F.shiftright("draw", shift + _CELL_BITS) == F.col("cell"))
            .groupBy("source", F.shiftright("draw", shift).alias("part"))
            .agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("used").alias("used"))
            .withColumn("upto", F.sum("size").over(order) + F.col("used"))
            .where(F.col("upto") > F.col("rest"))
            .groupBy("source", "rest")
            .agg(F.min_by(F.struct("part", (F.col("upto") - F.col("size")).alias("used")), "part").alias("at"))
            .select("source", "rest", F.col("at.part").alias("cell"), F.col("at.used").alias("used"))
        )
        at = settle(inside, "mixing-cells")
    shift = _DRAW_BITS - _CELL_BITS * _LEVELS
    below = F.shiftleft("cell", shift) - 1
    found = (
        _join(sized, at, bounded)
        .where(F.shiftright("draw", shift) == F.col("cell"))
        .groupBy("source", "draw")
        .agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("used").alias("used"))
        .withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("draw")) + F.col("used"))
        .where(F.col("upto") <= F.col("rest"))
        .groupBy("source")
        .agg(F.max("draw").alias("last"))
    )
    return at.select("source", below.alias("below")).join(
        found.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).select("source", F.coalesce("last", "below").alias("cut"))


def _fill(sized: DataFrame, cuts: DataFrame, bounded: bool) -> tuple[DataFrame, DataFrame]:
    """source, steps (how the partial pass goes on after its cut); and source, draw, size of ids that repeat.

    `cuts` has source, rest and cut. A step takes the documents with after < draw <= upto and 1 to `open` words.
    Steps follow each other along the draw, and a new one begins behind a document that doesn't fit, so
    that together they take each document that still fits. Rows of one id count as one document.
    """
    groups = (
        _join(sized, cuts.select("source", "cut"), bounded)
        .where(F.col("draw") > F.col("cut"))
        .groupBy("source", "draw")
        .agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    )
    groups = settle(groups, "mixing-rest")
    sum_taken = F.coalesce(F.sum(F.when(F.col("draw") <= F.col("cut"), F.col("size"))), F.lit(0).cast("long"))
    steps = F.array().cast("array<struct<after:bigint,upto:bigint,open:double>>")
    at = (
        _join(sized, cuts, bounded)
        .groupBy("source", "rest", "cut")
        .agg(sum_taken.alias("used"))
        .withColumn("steps", steps)
    )
    at = settle(at, "mixing-fill")
    left = groups.select("source", "draw", "size")
    still_open = F.col("rest") - F.col("used")
    while True:
        fits = (F.col("draw") > F.col("cut")) & F.col("size").between(1, still_open)
        left = settle(_join(left, at.drop("steps"), bounded).where(fits).select("source", "draw", "size"), "mixing-left")
        many = left.groupBy("source").agg(F.count("*").alias("n"), F.max("draw").alias("last"))
        many = settle(_join(at, many.where(F.col("n") > FEW_LEFT), bounded), "mixing-many")
        if not many.limit(1).count():
            break
        ends = _cut_draws(left, many.select("source", still_open.alias("rest")), bounded)
        ends = ends.select(F.col("source").alias("_source"), F.col("cut").alias("end"))
        ends = many.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", F.coalesce("end", "last").alias("upto")
        )
        ends = settle(ends, "mixing-ends")
        gained = _join(left, ends, bounded).where(F.col("draw") <= F.col("upto")).groupBy("source", "upto")
        gained = gained.agg(F.sum("size").alias("gained")).withColumnRenamed("source", "_source")
        step = F.array(F.struct(F.col("cut").alias("after"), "upto", still_open.alias("open")))
        moved = F.col("upto").isNotNull()
        at = at.join(gained, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "rest", F.coalesce("upto", "cut").alias("cut"),
            (F.col("used") + F.coalesce("gained", F.lit(0))).alias("used"),
            F.when(moved, F.concat("steps", step)).otherwise(F.col("steps")).alias("steps"),
        )
        at = settle(at, "mixing-fill")

    def go_on(state: Column, item: Column) -> Column:
        last = F.element_at(state["steps"], -1)
        begun = F.concat(
            state["steps"],
            F.array(F.struct(state["cut"].alias("after"), item["draw"].alias("upto"), (F.col("rest") - state["used"]).alias("open"))),
        )
        longer = F.concat(
            F.slice(state["steps"], F.lit(1), F.size(state["steps"]) - 1),
            F.array(F.struct(last["after"].alias("after"), item["draw"].alias("upto"), last["open"].alias("open"))),
        )
        fits = item["size"] <= F.col("rest") - state["used"]
        return F.struct(
            F.when(fits, state["used"] + item["size"]).otherwise(state["used"]).alias("used"),
            F.when(fits, item["draw"]).otherwise(state["cut"]).alias("cut"),
            (~fits).alias("skipped"),
            F.when(~fits, state["steps"]).when(state["skipped"], begun).otherwise(longer).alias("steps"),
        )

    listed = left.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("draw", "size"))).alias("items"))
    start = F.struct("used", "cut", F.lit(True).alias("skipped"), "steps")
    whole = F.aggregate("items", start, go_on, lambda state: state["steps"])
    filled = at.join(listed.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left")
    filled = filled.select("source", F.when(F.col("items").isNull(), F.col("steps")).otherwise(whole).alias("steps"))
    return settle(filled, "mixing-steps"), groups.where("rows > 1").select("source", "draw", "size")


def block(draw_column: Column, blocks: Column) -> Column:
    share = draw_column.cast("double") / F.lit(float(1 << _DRAW_BITS))
    return F.least(F.floor(share * blocks).cast("long"), blocks - 1)


def _log_factorial(n: Column) -> Column:
    n = n.cast("double")
    x = F.greatest(n, F.lit(10.0))
    series = x * F.log(x) - x + F.log(x * F.lit(6.283185307179586)) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x)
    series = series + 1 / (1260 * x * x * x * x * x)
    low = F.element_at(F.array(*map(F.lit, _LOG_FACTORIALS)), F.least(n, F.lit(9.0)).cast("int") + 1)
    return F.when(n < 10, low).otherwise(series)


def hypergeometric(u: Column, total: Column, good: Column, take: Column) -> Column:
    """How many of `take` units, drawn from `total` of which `good` count, do: the value at quantile u.

    The distribution function is summed from eight deviations below the mean to eight above.
    """
    bad = total - good
    every = F.greatest(total, F.lit(1))
    mean = take * good / every
    sd = F.sqrt(mean * bad / every * (total - take) / F.greatest(total - 1, F.lit(1)))
    low = F.greatest(F.lit(0).cast("long"), take - bad, F.floor(mean - 8 * sd - 2).cast("long"))
    high = F.least(take, good, F.ceil(mean + 8 * sd + 2).cast("long"))
    lf = _log_factorial

    def found(given: Column) -> Column:
        a, b, good, bad, take, u = (given[name] for name in ("a", "b", "good", "bad", "take", "u"))
        first = F.exp(
            lf(good) - lf(a) - lf(good - a) + lf(bad) - lf(take - a) - lf(bad - take + a)
            - lf(good + bad) + lf(take) + lf(good + bad - take)
        )

        def step(state: Column, k: Column) -> Column:
            upto = state["upto"] + state["p"]
            more = (good - k).cast("double") * (take - k) / ((k + 1).cast("double") * (bad - take + k + 1))
            return F.struct(
                F.when(k < b, state["p"] * more).otherwise(F.lit(0.0)).alias("p"),
                upto.alias("upto"),
                F.when(upto < u, F.least(k + 1, b)).otherwise(state["found"]).alias("found"),
            )

        start = F.struct(first.alias("p"), F.lit(0.0).alias("upto"), a.alias("found"))
        return F.aggregate(F.sequence(a, b), start, step, lambda state: state["found"])

    given = F.struct(low.alias("a"), high.alias("b"), good.alias("good"), bad.alias("bad"), take.alias("take"), u.alias("u"))
    return _let(given, found)


def _let(value: Column, use) -> Column:
    """An expression of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _uniform(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """stratum, offsets: where each shard's run of the stratum's block draws begins, and the end.

    `quotas` has stratum (0, 1, ...) and quota. Each node of the tree is one row with all quotas.
    """
    listed = F.array_sort(F.collect_list(F.struct("stratum", "quota")))
    nodes = quotas.agg(listed.alias("rows")).select(
        F.transform("rows", lambda r: r["stratum"]).alias("strata"),
        F.transform("rows", lambda r: r["quota"]).alias("quota"),
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"),
    )
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    room = F.floor(F.col("total") * (F.col("middle") - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")

    def step(state: Column, item: Column) -> Column:
        u = _uniform(F.lit(seed), item["lo"], item["hi"], item["i"])
        got = (
            F.when(state["room"] >= state["rest"], item["q"])
            .when(state["room"] == 0, F.lit(0).cast("long"))
            .otherwise(hypergeometric(u, state["rest"], item["q"], state["room"]))
        )
        return F.struct(got.alias("got"), state["room"].alias("room"), state["rest"].alias("rest"), state["out"].alias("out"), item["q"].alias("q"))

    def settled_step(state: Column, item: Column) -> Column:
        return _let(step(state, item), lambda s: F.struct(
            (s["room"] - s["got"]).alias("room"),
            (s["rest"] - s["q"]).alias("rest"),
            F.concat(s["out"], F.array(s["got"])).alias("out"),
        ))

    items = F.transform("quota", lambda q, i: F.struct(q.alias("q"), i.alias("i"), F.col("lo").alias("lo"), F.col("hi").alias("hi")))
    start = F.struct(room.alias("room"), F.col("total").alias("rest"), F.array().cast("array<long>").alias("out"))
    left = F.aggregate(items, start, settled_step, lambda state: state["out"])

    def halves(x: Column) -> Column:
        rest = F.zip_with("quota", x, lambda q, y: q - y)
        return F.array(
            F.struct(x.alias("quota"), F.col("lo"), F.col("middle").alias("hi")),
            F.struct(rest.alias("quota"), F.col("middle").alias("lo"), F.col("hi")),
        )

    whole = F.array(F.struct(F.col("quota"), F.col("lo"), F.col("hi")))
    total = F.aggregate("quota", F.lit(0).cast("long"), lambda s, x: s + x)
    parts = F.when(F.col("hi") - F.col("lo") > 1, _let(left, halves)).otherwise(whole)
    for _ in range(max(shards - 1, 0).bit_length()):
        nodes = nodes.withColumn("total", total).withColumn("middle", middle)
        nodes = nodes.select("strata", F.explode(parts).alias("n")).select("strata", "n.quota", "n.lo", "n.hi")
        nodes = settle(nodes, "mixing-tree")
    runs = nodes.select(F.explode(F.arrays_zip("strata", "quota")).alias("x"), "lo").select("x.strata", "x.quota", "lo")
    listed = F.array_sort(F.collect_list(F.struct("lo", "quota")))
    sums = F.aggregate(
        F.col("runs"), F.array(F.lit(0).cast("long")),
        lambda s, r: F.concat(s, F.array(F.element_at(s, -1) + r["quota"])),
    )
    return runs.groupBy(F.col("strata").alias("stratum")).agg(listed.alias("runs")).select("stratum", sums.alias("offsets"))


def plan_mix(documents: DataFrame, shards: int = SHARDS, seed: int = 7) -> tuple[DataFrame, bool]:
    """One row per source: source_size, target, passes, cut, steps, blocks, base, offsets, parts, partial; and whether it is small.

    parts: the number of parts of each shard, so that one has WORDS_PER_PART words or less. partial: the blocks
    of the partial pass; documents beyond its cut are dealt with these.
    """
    plan, bounded, _ = _planned(documents, shards, seed)
    return plan, bounded


def _planned(documents: DataFrame, shards: int, seed: int) -> tuple[DataFrame, bool, DataFrame]:
    sized = settle(
        documents.select("source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), seed).alias("draw")),
        "mixing-sizes",
    )
    share = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = settle(
        source_targets(sized)
        .withColumn("passes", share)
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("blocks", F.ceil(F.col("docs") / DOCS_PER_BLOCK).cast("long")),
        "mixing-sources",
    )
    bounded = sources.count() <= BROADCAST_SOURCES
    cuts = _cut_draws(sized, sources, bounded).withColumnRenamed("source", "_source")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cuts = sources.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    cuts = settle(cuts.withColumn("cut", F.coalesce("cut", F.lit(-1).cast("long"))), "mixing-cuts")
    steps, repeats = _fill(sized, cuts.select("source", "rest", "cut"), bounded)
    cuts = _join(cuts, steps, bounded)
    partial = F.when(F.col("cut") >= 0, block(F.col("cut"), F.col("blocks")) + 1).otherwise(F.least(F.size("steps"), F.lit(1)))
    quotas = settle(
        cuts.withColumn("partial", partial.cast("long"))
        .withColumn("quota", F.col("passes") * F.col("blocks") + F.col("partial"))
        .withColumn("stratum", F.pmod(F.row_number().over(by_name) - 1, F.lit(STRATA)))
        .withColumn("base", F.sum("quota").over(Window.partitionBy("stratum").orderBy(F.col("source").asc_nulls_last())) - F.col("quota")),
        "mixing-quotas",
    )
    offsets = split_quotas(quotas.groupBy("stratum").agg(F.sum("quota").alias("quota")), shards, seed)
    words = F.sum("source_size").over(Window.partitionBy())
    parts = F.greatest(F.ceil(words / (shards * WORDS_PER_PART)), F.lit(1)).cast("int")
    plan = quotas.join(offsets, "stratum").select(
        "source", "source_size", "target", "passes", "cut", "steps", "blocks", "base", "offsets", parts.alias("parts"), "partial"
    )
    return settle(plan, "mixing-plan"), bounded, repeats


def mix(documents: DataFrame, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """The documents with source_size, target and places: one (pass, shard, part, rank) for each copy taken.
    A shard's order is that of part and rank, which is random.

    `documents` needs doc_id, text and source; other columns stay unless they have one of the three new
    names, which replace them. A null or blank text has size 0 and is in whole passes only; a null source is a
    source of its own; documents with one id are taken alike. An empty table gives an empty one.
    """
    plan, bounded, repeats = _planned(documents, shards, seed)
    ours = [c for c in documents.columns if c.lower() not in ("source_size", "target", "places")]
    plan_name, draw_name, source_name, twin_name, size_name = free_names(ours, "plan", "draw", "source", "twin", "size")
    plan = plan.select("source", F.struct(*[c for c in plan.columns if c != "source"]).alias(plan_name))
    d, p = F.col(draw_name), F.col(plan_name)
    drawn = documents.select(*ours).withColumn(draw_name, draw(F.col("doc_id"), seed))
    # rows of a repeated id are taken alike, by the words of all
    repeats = repeats.select(F.col("source").alias(source_name), F.col("draw").alias(twin_name), F.col("size").alias(size_name))
    same = F.col("source").eqNullSafe(F.col(source_name)) & (d == F.col(twin_name))
    drawn = drawn.join(repeats, same, "left").drop(source_name, twin_name)
    size = F.coalesce(F.col(size_name), word_count(F.col("text")))
    taking = F.filter(p["steps"], lambda x: (d > x["after"]) & (d <= x["upto"]))
    partial = ((d <= p["cut"]) & (size > 0)) | F.exists(taking, lambda x: size.between(1, x["open"]))
    copies = p["passes"] + F.when(partial, 1).otherwise(0)
    at = block(d, p["blocks"])

    def place(i: Column) -> Column:
        # what is taken beyond the cut is dealt with the blocks before it
        index = p["base"] + i * p["blocks"] + F.when(i < p["passes"], at).otherwise(F.pmod(at, p["partial"]))
        shard = F.size(F.filter(p["offsets"], lambda o: o <= index)) - 1
        rank = F.xxhash64(F.lit(seed + 1), i, d)
        part = F.pmod(F.shiftright(rank, 20), p["parts"]).cast("int")
        return F.struct(i.cast("int").alias("pass"), shard.alias("shard"), part.alias("part"), rank.alias("rank"))

    none = F.array().cast("array<struct<pass:int,shard:int,part:int,rank:bigint>>")
    places = F.when(copies > 0, F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), place)).otherwise(none)
    return _join(drawn, plan, bounded).select(
        *ours, p["source_size"].alias("source_size"), p["target"].alias("target"), places.alias("places")
    )


def taken(mixed: DataFrame) -> DataFrame:
    """One row per document and copy taken, dealt to tasks by shard and part and in random order inside."""
    rows = mixed.select("*", F.explode("places").alias("_place"))
    kept = [c for c in mixed.columns if c != "places"]
    rows = rows.select(*kept, "_place.shard", "_place.part", "_place.rank")
    return rows.repartition("shard", "part").sortWithinPartitions("shard", "part", "rank")


def write_shards(mixed: DataFrame, path: str) -> None:
    """Write the taken rows as one folder a shard and part, in random order inside."""
    taken(mixed).drop("rank").write.partitionBy("shard", "part").parquet(path)
