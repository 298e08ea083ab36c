"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Method. Every source gets a target (its weight's share of the wanted total, stopped at ``most`` times
its size, the excess shared among the others). The wanted total is cut into blocks of ``block`` words,
and the blocks go to the sources by the highest quotients target / (2 k + 1). A source is dealt out
into shards by a hash of the id, and its blocks go to its shards in the same way by their sizes. In
a shard the documents follow one another in a seeded order, cut into equal blocks of ``block`` words
(as near as the shard's size allows); a seeded stride picks as many of them as the quota says, each
at most ``most`` times.

Results. One row per input row. ``taken`` counts the words of the picked blocks that lie in the
document, repeats counted; it is never over ``most`` times its size. A null or blank text has size 0
and is never taken; a null source is a source of its own and comes last. Rows with equal id and
text change places without effect. An empty table gives no rows; extra columns are not read.
Nothing depends on how rows are laid out, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.storage import shared_folder, staged

WEIGHTS = (3, 1, 2)
#: Words in a block, and in a shard about.
BLOCK, SHARD = 64, 1 << 20
#: A prime over any number of blocks in a shard, so that multiples of it visit every block once.
STRIDE = 2_147_483_647
#: Words of a text, as a SQL expression.
SIZE = r"cast(coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0) AS long)"


def pick(*parts: Column | str) -> Column:
    """A whole number below 2**31 that depends on the parts only."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def targets(sources: DataFrame, share: float, most: int, weights: tuple[int, ...]) -> DataFrame:
    """Adds ``weight`` and ``target``: water-filling over sources in order of size by weight.

    Before its turn a source would get ``level`` times its weight, all smaller ones being full.
    """
    everything, by_room = Window.partitionBy(), Window.orderBy("room", "rank").rowsBetween(Window.unboundedPreceding, -1)
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sources.withColumn("rank", nth).withColumns({
        "weight": F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")),
        "wanted": share * F.sum("source_size").over(everything),
    }).withColumn("room", most * F.col("source_size") / F.col("weight"))
    level = (F.col("wanted") - most * F.coalesce(F.sum("source_size").over(by_room), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0))
    )
    leveled = weighed.withColumn("level", level)
    reached = F.min_by("level", F.when(F.col("level") <= F.col("room"), F.struct("room", "rank"))).over(everything)
    return leveled.withColumn("reached", reached).select(
        "source", "source_size", "rank",
        F.when(F.col("level") > F.col("room"), (most * F.col("source_size")).cast("double"))
        .otherwise(F.col("reached") * F.col("weight")).alias("target"),
    )


def apportioned(df: DataFrame, group: list[str], votes: str, seats: Column, order: list[str], name: str) -> DataFrame:
    """Adds column ``name``: seats by the highest quotients votes / (2 k + 1) within each group.

    Rounding every fair share is the exact result for a number of seats near the wanted one; only
    the seats between the two are ranked by their quotients, at most a few a row.
    """
    whole = Window.partitionBy(*group)
    shares = df.withColumn("votes_all", F.sum(votes).over(whole)).withColumn("seats_all", seats).withColumn(
        "first", F.when(F.col("votes_all") > 0, F.floor(F.col(votes) * F.col("seats_all") / F.col("votes_all") + 0.5)).otherwise(0)
    )
    shares = shares.withColumn("missing", F.col("seats_all") - F.sum("first").over(whole)).withColumn(
        "reach",
        F.when(F.col("votes_all") > 0, F.ceil(F.col(votes) / F.col("votes_all") * (F.abs("missing") + F.count("*").over(whole))) + 1)
        .otherwise(0),
    )
    more, fewer = F.col("missing") > 0, F.col("missing") < 0
    steps = (
        F.when(more & (F.col("reach") > 0), F.sequence("first", F.col("first") + F.col("reach")))
        .when(fewer & (F.col("first") > 0), F.sequence(F.greatest(F.lit(0), F.col("first") - F.col("reach")), F.col("first") - 1))
        .otherwise(F.array().cast("array<long>"))
    )
    quotients = shares.select(*group, *order, "missing", F.explode(steps).alias("k"), F.col(votes).alias("v")).withColumn(
        "quotient", F.col("v") / (2 * F.col("k") + 1)
    )
    best = F.row_number().over(whole.orderBy(F.desc("quotient"), *order))
    worst = F.row_number().over(whole.orderBy("quotient", *[F.desc(c) for c in order]))
    moved = quotients.withColumn("nth", F.when(more, best).otherwise(worst)).filter("nth <= abs(missing)")
    moved = moved.groupBy(*order).agg(F.count("*").alias("moved"))
    return shares.join(moved, order, "left").withColumn(
        name, F.col("first") + F.signum("missing").cast("long") * F.coalesce("moved", F.lit(0))
    ).drop("votes_all", "seats_all", "first", "missing", "reach", "moved")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.5, most: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix",
    block: int = BLOCK, shard: int = SHARD, keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``keep`` for every row; see the module."""
    folder = shared_folder(docs.sparkSession)
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"),
        *keep,
    )
    sizes = staged(named.select("doc_id", "source", F.expr(SIZE).alias("size"), *keep), folder, "sizes")
    sources = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), share, most, weights)
    seats = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    sources = staged(apportioned(sources, [], "target", seats, ["rank"], "quota"), folder, "sources")
    dealt = sizes.join(
        sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).withColumn("shard", pick(seed, F.col("doc_id")) % F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)))
    dealt = dealt.select("doc_id", "rank", "shard", "size", "source_size", "target", "quota", *keep)
    shards = dealt.groupBy("rank", "shard", "quota").agg(F.sum("size").alias("shard_size")).withColumnRenamed("quota", "seats")
    shards = apportioned(shards, ["rank"], "shard_size", F.col("seats"), ["rank", "shard"], "quota").select(
        "rank", "shard", "shard_size", F.greatest(F.lit(1), F.round(F.col("shard_size") / block)).cast("long").alias("blocks"), "quota"
    ).withColumn("quota", F.least("quota", most * F.col("blocks")))
    end = F.sum("size").over(
        Window.partitionBy("rank", "shard").orderBy(pick(seed, "order", F.col("doc_id")), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = dealt.drop("quota").withColumn("end", end).join(shards, ["rank", "shard"]).withColumns({
        "start": F.col("end") - F.col("size"), "offset": pick(seed, "offset", F.col("rank"), F.col("shard")),
    })
    taken = F.expr(f"""
        aggregate(sequence(((start + 1) * blocks - 1) div shard_size, (end * blocks - 1) div shard_size), 0L, (sum, b) -> sum
            + (least(end, (b + 1) * shard_size div blocks) - greatest(start, b * shard_size div blocks))
            * (quota div blocks + if((b * {STRIDE} + offset) % blocks < quota % blocks, 1, 0)))
    """)
    return placed.select(
        "doc_id", *keep, "size", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(F.lit(0)).cast("long").alias("taken")
    )


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; a part of a row is rounded by a seeded draw."""
    kept = docs.columns
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)])
    column = dict(zip(kept, named.columns))
    rows = staged(named.withColumn("row", F.monotonically_increasing_id()), shared_folder(docs.sparkSession), "rows")
    mix = mixed(rows, column[id_col], column[text_col], column[source_col], keep=("row",), **options)
    draw = pick("copies", F.col("doc_id")) / (1 << 28)
    copies = F.floor(F.col("taken") / F.greatest(F.lit(1), F.col("size")) + draw).cast("int")
    often = mix.select("row", copies.alias("copies")).filter("copies > 0")
    return rows.join(often, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*named.columns).toDF(*kept)
