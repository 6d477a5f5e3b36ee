"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are dealt into blocks. A source's target asks for so many words: whole passes over its
blocks, then permuted blocks until the rest is met, the last of them in part. The drawn blocks are quotas of
the source; a binary tree over the output shards splits the vector of quotas at each node by a multivariate
hypergeometric draw, so that each shard gets exact, disjoint ranges of every source's permuted blocks and only
shuffles what it holds. Everything is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import compact, materialize, partitions_for

# Words are maximal runs of characters other than \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


@dataclass(frozen=True)
class Mix:
    """weights repeat over the sources in code-point order; share: of all words; most: of a source's own words."""

    weights: tuple[int, ...] = WEIGHTS
    share: float = 1.5
    most: int = 2
    block_words: int = 200_000
    shard_blocks: int = 16
    seed: int = 7


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def key_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A row's place in the permutation of its block: 32 hexadecimal digits."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))))


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, place, source_size, weight, target): shares by weight, capped, the excess reshared among the rest.

    Resharing by weight until none is above its cap ends at min(cap, weight * level) with one common level;
    ordered by cap / weight, the level is that of the first source which stays under its cap.
    """
    n = len(mix.weights)
    weights = F.array(*[F.lit(w) for w in mix.weights])
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)  # one row a source
    s = s.withColumn("weight", F.element_at(weights, F.col("place") % n + 1).cast("double"))
    s = s.withColumn("cap", (F.col("source_size") * mix.most).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", "place")
    s = s.withColumn("before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
    s = s.withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    everything = Window.partitionBy(F.lit(0))
    s = s.withColumn("wanted", F.sum("source_size").over(everything) * mix.share)
    s = s.withColumn("level", (F.col("wanted") - F.col("before")) / F.col("rest"))
    s = s.withColumn("free", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything))
    capped = F.col("free").isNull() | (F.struct("ratio", "place") < F.struct(F.col("free.ratio").alias("ratio"), F.col("free.place").alias("place")))
    return s.select("source", "place", "source_size", "weight", F.when(capped, F.col("cap")).otherwise(F.col("weight") * F.col("free.level")).alias("target"))


def _blocks(source_size: Column, mix: Mix) -> Column:
    return F.greatest(F.lit(1), F.ceil(source_size / F.lit(mix.block_words))).cast("long")


def _block(key: Column, source_size: Column, mix: Mix) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % _blocks(source_size, mix)


def _uniform(*parts: Column) -> Column:
    """A number between 0 and 1 fixed by its arguments."""
    return (F.pmod(F.xxhash64(*parts), F.lit(2**52)) + 0.5) / F.lit(float(2**52))


def _bind(f, **values: Column) -> Column:
    """f of a struct of values that are evaluated once."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), f), F.lit(0))


def hypergeometric(n: Column, k: Column, whole: Column, u: Column) -> Column:
    """How many of k marked ones are among n drawn of the whole: by inversion of u, exact in double precision.

    The support is listed outward from the mode, where the chances relative to the mode's follow from their ratios;
    beyond 40 standard deviations they are below what a double can add.
    """
    none = F.expr("cast(array() as array<bigint>)")

    def bounds(x: Column) -> Column:
        low, high = F.greatest(F.lit(0).cast("long"), x["n"] - (x["whole"] - x["k"])), F.least(x["k"], x["n"])
        mode = F.floor((x["n"] + 1) * (x["k"] + 1).cast("double") / (x["whole"] + 2)).cast("long")
        share = x["k"] / F.greatest(x["whole"], F.lit(1))
        reach = (F.ceil(40 * F.sqrt(x["n"] * share * (1 - share))) + 40).cast("long")
        mode = F.greatest(low, F.least(high, mode))
        return _bind(lists, n=x["n"], k=x["k"], rest=x["whole"] - x["k"] - x["n"], u=x["u"], mode=mode, first=F.greatest(low, mode - reach), last=F.least(high, mode + reach))

    def lists(x: Column) -> Column:
        up = F.when(x["last"] > x["mode"], F.sequence(x["mode"] + 1, x["last"])).otherwise(none)
        down = F.when(x["mode"] > x["first"], F.sequence(x["mode"] - 1, x["first"])).otherwise(none)
        return _bind(total, n=x["n"].cast("double"), k=x["k"].cast("double"), rest=x["rest"].cast("double"), u=x["u"], mode=x["mode"], up=up, down=down)

    def walk(x: Column, start: Column, goal: Column) -> Column:
        """(sum of the chances, the place where it passes the goal), the mode's chance being 1."""
        def step(ratio):
            def go(acc: Column, i: Column) -> Column:
                return _bind(
                    lambda w: F.struct(w["w"].alias("w"), (acc["sum"] + w["w"]).alias("sum"), F.coalesce(acc["got"], F.when(acc["sum"] + w["w"] > goal, i)).alias("got")), w=acc["w"] * ratio(i.cast("double"))
                )

            return go

        rise = lambda i: (x["k"] - i + 1) * (x["n"] - i + 1) / (i * (x["rest"] + i))
        fall = lambda i: (i + 1) * (x["rest"] + i + 1) / ((x["k"] - i) * (x["n"] - i))
        above = F.aggregate(x["up"], start, step(rise))
        return _bind(lambda a: F.aggregate(x["down"], F.struct(F.lit(1.0).alias("w"), a["a"]["sum"].alias("sum"), a["a"]["got"].alias("got")), step(fall)), a=above)

    def total(x: Column) -> Column:
        begin = lambda got: F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), got.cast("long").alias("got"))
        found = lambda y: F.coalesce(walk(x, begin(F.when(y["goal"] < 1, x["mode"])), y["goal"])["got"], x["mode"])
        return _bind(found, goal=x["u"] * walk(x, begin(F.lit(None)), F.lit(float("inf")))["sum"])

    return _bind(bounds, n=n.cast("long"), k=k.cast("long"), whole=whole.cast("long"), u=u)


#: Nodes of the splitting tree from which on its levels are made in parallel.
SPREAD = 64


def split_quotas(quotas: DataFrame, shards: int, mix: Mix) -> DataFrame:
    """(place, shard, quota) from (place, quota): every quota is dealt out exactly, every shard gets its capacity.

    A node splits its quotas between the shards of its left and right half: source after source, the left
    count is a hypergeometric draw given those before it. The first levels are a few rows, one for each node; from
    SPREAD nodes on they are dealt over the tasks and each subtree goes its own way.
    """
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("place", "quota"))).alias("q")).select(
        F.transform("q", lambda x: x["place"]).alias("places"), F.transform("q", lambda x: x["quota"]).alias("q"), F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("n")
    )
    zero = F.lit(0).cast("long")
    for level in range(max(0, (shards - 1).bit_length())):
        if 1 << level == SPREAD:
            node = materialize(compact(node, SPREAD)).repartition(max(SPREAD, int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "first")
        half = F.expr("n div 2")
        whole = F.aggregate("q", zero, lambda a, x: a + x)

        def draw(acc, x):
            got = hypergeometric(acc["rest"], x["q"], acc["all"], _uniform(F.lit(mix.seed), F.col("first"), F.col("n"), x["i"]))
            return _bind(lambda g: F.struct((acc["rest"] - g["got"]).alias("rest"), (acc["all"] - x["q"]).alias("all"), F.concat(acc["out"], F.array(g["got"])).alias("out")), got=got)

        items = F.transform("q", lambda x, i: F.struct(x.alias("q"), i.alias("i")))
        capacity = F.round(whole * half / F.col("n")).cast("long")
        start = F.struct(capacity.alias("rest"), whole.alias("all"), F.expr("cast(array() as array<bigint>)").alias("out"))
        node = node.withColumn("left", F.aggregate(items, start, draw, lambda a: a["out"]))
        right = F.zip_with("q", "left", lambda a, b: a - b)
        children = F.array(
            F.struct(F.col("left").alias("q"), F.col("first").alias("first"), half.alias("n")),
            F.struct(right.alias("q"), (F.col("first") + half).alias("first"), (F.col("n") - half).alias("n")),
        )
        node = node.select("places", F.explode(F.filter(children, lambda c: c["n"] > 0)).alias("c")).select("places", "c.q", "c.first", "c.n")
    return node.select(F.col("first").alias("shard"), F.explode(F.arrays_zip("places", "q")).alias("x")).select(F.col("x.places").alias("place"), "shard", F.col("x.q").alias("quota"))


def _running(df: DataFrame, order: list[str], bucket: Column, **values: Column) -> DataFrame:
    """df with running sums of values over the rows of each place in order. bucket rises with the order: a place is
    summed up by bucket first, so that no task has to take the rows of a whole place."""
    d = df.withColumn("bucket", bucket)
    sums = d.groupBy("place", "bucket").agg(*[F.sum(v).alias(f"all_{k}") for k, v in values.items()])
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("place", "bucket", *[F.coalesce(F.sum(f"all_{k}").over(earlier), F.lit(0)).alias(f"before_{k}") for k in values])
    inside = Window.partitionBy("place", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({k: F.sum(v).over(inside) for k, v in values.items()}).join(before, ["place", "bucket"])
    return d.withColumns({k: F.col(k) + F.col(f"before_{k}") for k in values}).drop("bucket", *[f"before_{k}" for k in values])


def plan_blocks(rows: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """From (source, size, key): targets, and (source, block, draws, cut, cut_words) for every block drawn.

    draws: the shards of the whole draws of a block and, flagged, of a draw in part: rows with a key under cut
    are in it, rows at cut with cut_words words.
    """
    t = materialize(targets(rows, mix))  # one row a source, in one partition as its windows are
    words, sources = t.agg(F.sum("source_size"), F.count("*")).first()
    n_blocks = (words or 0) // mix.block_words + sources
    goal = t.select("source", "place", "source_size", "target", _blocks(F.col("source_size"), mix).alias("n_blocks"))
    goal = goal.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("rest", F.when(F.col("source_size") > 0, F.floor(F.col("target") - F.col("passes") * F.col("source_size"))).otherwise(0).cast("long"))
    dealt = _with_target(rows, t)
    blocks = dealt.withColumn("block", _block(F.col("key"), F.col("source_size"), mix)).groupBy("place", "block").agg(F.sum("size").alias("words"))
    blocks = materialize(compact(blocks, n_blocks).withColumn("turn", F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("place"), F.col("block")))))
    counts = blocks.groupBy("place").agg(F.count("*").alias("count"))
    blocks = _running(blocks, ["turn", "block"], F.substring("turn", 1, 3), upto=F.col("words"), rank=F.lit(1)).withColumn("rank", F.col("rank") - 1)
    blocks = blocks.join(counts, "place").join(goal.select("place", "passes", "rest"), "place")
    blocks = materialize(
        compact(blocks, n_blocks).select(
            "place", "block", "rank", "count", "passes",
            (F.col("upto") <= F.col("rest")).alias("again"),
            F.when((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")), F.col("rest") - F.col("upto") + F.col("words")).alias("part"),
        )
    )
    drawn_again = F.col("again") | F.col("part").isNotNull()
    draws = blocks.select("*", F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda i: (i < F.col("passes")) | drawn_again)).alias("draw"))
    draws = draws.select("place", "block", (F.col("draw") * F.col("count") + F.col("rank")).alias("turn"), ((F.col("draw") == F.col("passes")) & F.col("part").isNotNull()).alias("in_part"))
    quotas = materialize(compact(draws.groupBy("place").agg(F.count("*").alias("quota")), sources))
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-total // mix.shard_blocks))
    dealt_out = materialize(compact(split_quotas(quotas, shards, mix).where("quota > 0"), total) if shards < SPREAD else split_quotas(quotas, shards, mix).where("quota > 0"))
    ranges = _running(dealt_out, ["shard"], F.expr("shard div 4096"), upto=F.col("quota")).select("place", "shard", F.explode(F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("turn"))
    drawn = draws.join(ranges, ["place", "turn"]).groupBy("place", "block").agg(F.sort_array(F.collect_list(F.struct("in_part", "shard"))).alias("draws"))
    # where the draw in part ends: a running sum over the rows of these blocks alone, one block a source at most
    cuts = dealt.withColumn("block", _block(F.col("key"), F.col("source_size"), mix)).join(blocks.where("part is not null").select("place", "block", "part"), ["place", "block"])
    cuts = cuts.groupBy("place", "block", "part", "key").agg(F.sum("size").alias("words"), F.count("*").alias("same"))
    upto = F.sum("words").over(Window.partitionBy("place", "block").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    cuts = cuts.withColumn("upto", upto).where("upto > part and upto - words <= part")
    cuts = cuts.groupBy("place", "block").agg(F.min(F.struct("key", F.floor((F.col("part") - F.col("upto") + F.col("words")) / F.col("same")).alias("words"))).alias("cut"))
    plan = drawn.join(cuts, ["place", "block"], "left").select("place", "block", "draws", F.col("cut.key").alias("cut"), F.col("cut.words").alias("cut_words"))
    return t, plan


def _with_target(rows: DataFrame, t: DataFrame) -> DataFrame:
    """rows with their source's place, size and target; one row a source on the other side."""
    s = t.select(F.col("source").alias("t_source"), "place", "source_size", "target")
    return rows.join(s, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")


def _join_plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """rows (source, size, key and others) with source_size, target, draws, part (words of the draw in part) and taken."""
    t, plan = plan_blocks(rows.select("source", "size", "key"), mix)
    out = _with_target(rows, t).withColumn("block", _block(F.col("key"), F.col("source_size"), mix)).join(plan, ["place", "block"], "left")
    part = F.when(F.col("key") < F.col("cut"), F.col("size")).when(F.col("key") == F.col("cut"), F.col("cut_words")).otherwise(0)
    part = F.when(F.exists("draws", lambda d: d["in_part"]), part).otherwise(0).cast("long")
    whole = F.coalesce(F.size(F.filter("draws", lambda d: ~d["in_part"])), F.lit(0))
    whole = F.when(F.col("draws").isNull(), 0).otherwise(whole)
    return out.withColumn("part", part).withColumn("taken", (F.col("size") * whole + F.col("part")).cast("long"))


def mix_sizes(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs.

    A null text has size 0; a null source is a source of its own, the last; a null or repeated doc_id stays as
    it is, and rows alike in doc_id and text take alike. taken adds up what the shards of the splitting tree drew of
    the row's block, whole or in part. Other columns are ignored. An empty table gives no rows. The text is read once, to a narrow table of sizes and keys; only that is shuffled.
    """
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of().alias("size"), key_of().alias("key")))
    return _join_plan(rows, mix).select("doc_id", "size", "source_size", "target", "taken")


def _mixed(docs: DataFrame, mix: Mix) -> tuple[DataFrame, int]:
    """mixed(docs), and how many words it has."""
    rows = docs.select("*", F.struct(F.col("source").cast("string").alias("source"), size_of().alias("size"), key_of().alias("key")).alias("fg"))
    t, plan = plan_blocks(materialize(rows.select("fg.*")), mix)
    s = t.select(F.col("source").alias("fg_source"), F.col("place").alias("fg_place"), F.col("source_size").alias("fg_size"))
    plan = plan.select(*[F.col(c).alias(f"fg_{c}") for c in ("place", "block", "draws", "cut", "cut_words")])
    out = rows.join(s, F.col("fg.source").eqNullSafe(F.col("fg_source"))).withColumn("fg_block", _block(F.col("fg.key"), F.col("fg_size"), mix)).join(plan, ["fg_place", "fg_block"])
    half = F.when(F.col("fg.key") < F.col("fg_cut"), True).when(F.col("fg.key") == F.col("fg_cut"), F.col("fg_cut_words") * 2 >= F.greatest(F.col("fg.size"), F.lit(1))).otherwise(False)
    out = out.select(*docs.columns, F.col("fg.key").alias("fg_key"), F.explode(F.filter("fg_draws", lambda d: ~d["in_part"] | half)).alias("fg_draw")).withColumn("fg_shard", F.col("fg_draw.shard")).drop("fg_draw")
    return out, int(t.agg(F.sum("target")).first()[0] or 0)


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """docs as the mix takes them, a row for each draw, with the draw's fg_shard and the row's fg_key.

    A draw in part takes whole documents: those of which it takes at least half of the words. Documents
    without words go with their block. Null sources, repeated rows and empty tables as in mix_sizes.
    """
    return _mixed(docs, mix)[0]


def _place_in_shard() -> Column:
    return F.md5(F.concat_ws(":", "fg_shard", "fg_key"))


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """mixed(docs) with fg_position: the shuffled order within each shard, which holds a bounded number of blocks."""
    local = Window.partitionBy("fg_shard").orderBy(_place_in_shard())
    return mixed(docs, mix).withColumn("fg_position", F.row_number().over(local)).drop("fg_key")


def mixed_shards(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """mixed(docs) with the columns of docs alone, dealt by shard and in each shard in its shuffled order: as written,
    a file holds whole shards."""
    out, words = _mixed(docs, mix)
    n = partitions_for(docs.sparkSession, 8 * words)
    return out.repartition(n, "fg_shard").sortWithinPartitions("fg_shard", _place_in_shard(), "fg_key").select(*docs.columns)
