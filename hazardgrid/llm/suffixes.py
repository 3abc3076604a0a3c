"""Suffix order of a table of strings by a distributed difference-cover algorithm.

The sample holds the positions 1 and 2 modulo 3 of every string. Their triples of
letters are sorted and named; the names, first of the positions 1 then of the
positions 2, make a shorter string, whose suffixes are ordered in the same way.
The remaining suffixes are merged in: one at position 0 and one of the sample
compare by a letter or two and the rank of the sample suffix behind. So three
sorts, of (letter, rank), (letter, letter, rank) and the sample's ranks, give each
suffix the number of suffixes before it.

A name of level k stands for 3^k letters. Once that reaches the depth asked for,
names are ranks: suffixes that agree so far share a place in the order, or stand in
places next to each other. Sorts are over distinct keys, so a triple that very many
suffixes share is one row of them; nothing but partition totals meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardgrid.llm.batches import stored

_BEFORE = Window.unboundedPreceding, -1


def _totals_before(spark: SparkSession, keys: DataFrame, under: str | None) -> DataFrame:
    """Of (kind, k1, k2, k3, zeros, others): the sums of both over the smaller keys of a kind."""
    ordered = keys.orderBy("kind", "k1", "k2", "k3").withColumn("part", F.spark_partition_id())
    ordered = stored(spark, ordered, "keys", under)
    parts = ordered.groupBy("kind", "part").agg(F.sum("zeros").alias("pz"), F.sum("others").alias("po"))
    over = Window.partitionBy("kind").orderBy("part").rowsBetween(*_BEFORE)
    parts = parts.select(
        "kind",
        "part",
        F.coalesce(F.sum("pz").over(over), F.lit(0)).alias("pz"),
        F.coalesce(F.sum("po").over(over), F.lit(0)).alias("po"),
    )
    inside = Window.partitionBy("kind", "part").orderBy("k1", "k2", "k3").rowsBetween(*_BEFORE)
    return ordered.join(parts, ["kind", "part"]).select(
        "kind",
        "k1",
        "k2",
        "k3",
        (F.col("pz") + F.coalesce(F.sum("zeros").over(inside), F.lit(0))).alias("zeros"),
        (F.col("po") + F.coalesce(F.sum("others").over(inside), F.lit(0))).alias("others"),
    )


def _named(spark: SparkSession, padded: DataFrame, under: str | None) -> DataFrame:
    """(sid, names): sorted and named triples of the sample, as the next level's string."""
    triple = "struct(p[3 * j + {0}] as x, p[3 * j + {1}] as y, p[3 * j + {2}] as z)"
    thirds = "transform(sequence(0, cast(lp / 3 as int) - 1), j -> {})"
    triples = F.expr(
        f"concat({thirds.format(triple.format(1, 2, 3))}, {thirds.format(triple.format(2, 3, 4))})"
    )
    sample = padded.select("sid", F.posexplode(triples).alias("t", "s")).select("sid", "t", "s.x", "s.y", "s.z")
    names = sample.select("x", "y", "z").distinct().orderBy("x", "y", "z")
    names = stored(spark, names.withColumn("name", F.monotonically_increasing_id() + 1), "names", under)
    return (
        sample.join(names, ["x", "y", "z"])
        .groupBy("sid")
        .agg(F.sort_array(F.collect_list(F.struct("t", "name"))).alias("names"))
        .select("sid", F.expr("transform(names, e -> e.name)").alias("names"))
    )


def order(spark: SparkSession, strings: DataFrame, depth: int, span: int = 1, under: str | None = None) -> DataFrame:
    """(sid, ranks): for every wanted position a number that orders the suffixes there.

    ``strings``: distinct sid bigint, c array<bigint> of letters above 0, want
    array<boolean> per position. Suffixes that differ in their first ``depth`` letters
    are in lexicographic order (a string's end comes first); those that agree in them
    follow each other without others between. Positions that are not wanted have a null.
    Strings must each fit a row; one that is empty or has nothing wanted gives no row.
    Intermediate frames go ``under`` a scratch folder, if there is one.
    """
    padded = strings.withColumn("lp", F.expr("cast(3 * ((size(c) + 4) div 3) as int)")).select(
        "sid",
        "lp",
        F.expr("concat(c, array_repeat(0L, lp + 2 - size(c)))").alias("p"),
        F.expr("concat(want, array_repeat(false, lp - size(c)))").alias("w"),
        F.expr("size(c)").alias("n"),
    )
    named = _named(spark, padded, under)
    if 3 * span >= depth:
        named = named.withColumnRenamed("names", "r")
    else:
        # A sample suffix is needed at its own position and by the two before it.
        near = "transform(sequence(0, cast(lp / 3 as int) - 1), j -> w[3 * j + {0}] or w[3 * j + {0} - 1] or {1})"
        wanted = F.expr(f"concat({near.format(1, 'coalesce(get(w, 3 * j - 1), false)')}, {near.format(2, 'w[3 * j]')})")
        below = stored(
            spark,
            padded.join(named, "sid").select("sid", F.col("names").alias("c"), wanted.alias("want")),
            "level",
            under,
        )
        named = order(spark, below, depth, 3 * span, under).withColumnRenamed("ranks", "r")
    # r[j] is the rank of position 3j + 1, r[lp / 3 + j] that of 3j + 2.
    keys = F.expr(
        """transform(filter(sequence(0, lp - 1), i -> w[i]), i -> case i % 3
           when 0 then array(
             struct(i, 1 as kind, p[i] as k1, r[i div 3] as k2, 0L as k3),
             struct(i, 2 as kind, p[i] as k1, p[i + 1] as k2, r[lp div 3 + i div 3] as k3))
           when 1 then array(
             struct(i, 1 as kind, p[i] as k1, r[lp div 3 + i div 3] as k2, 0L as k3),
             struct(i, 3 as kind, r[i div 3] as k1, 0L as k2, 0L as k3))
           else array(
             struct(i, 2 as kind, p[i] as k1, p[i + 1] as k2, r[i div 3 + 1] as k3),
             struct(i, 3 as kind, r[lp div 3 + i div 3] as k1, 0L as k2, 0L as k3))
           end)"""
    )
    rows = padded.join(named, "sid").select("sid", "n", F.explode(F.flatten(keys)).alias("e"))
    rows = stored(spark, rows.select("sid", "n", "e.i", "e.kind", "e.k1", "e.k2", "e.k3"), "merged", under)
    zero = F.col("i") % 3 == 0
    counted = rows.groupBy("kind", "k1", "k2", "k3").agg(
        F.count_if(zero).alias("zeros"), F.count_if(~zero).alias("others")
    )
    # A sample suffix has its place in the sample and the position-0 suffixes before it;
    # one at position 0 has its place among those and the sample's two kinds before it.
    before = (
        F.when(F.col("kind") == 3, F.col("others"))
        .when(~zero, F.col("zeros"))
        .when(F.col("kind") == 1, F.col("zeros") + F.col("others"))
        .otherwise(F.col("others"))
    )
    return (
        rows.join(_totals_before(spark, counted, under), ["kind", "k1", "k2", "k3"])
        .select("sid", "n", "i", before.alias("before"))
        .repartition("sid")
        .groupBy("sid", "n", "i")
        .agg(F.sum("before").alias("rank"))
        .groupBy("sid", "n")
        .agg(F.map_from_entries(F.collect_list(F.struct("i", "rank"))).alias("m"))
        .select("sid", F.expr("transform(sequence(0, n - 1), i -> m[i])").alias("ranks"))
    )


def shared_prefixes(spark: SparkSession, suffixes: DataFrame) -> DataFrame:
    """Of (sid, i, rank, prefix): the (sid, i) whose prefix a neighbour in the order has too."""
    ordered = suffixes.orderBy("rank", "sid", "i").select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")
    )
    ordered = stored(spark, ordered, "adjacent")
    ends = ordered.groupBy("part").agg(
        F.min_by("prefix", "place").alias("first"), F.max_by("prefix", "place").alias("last")
    )
    parts = Window.orderBy("part")  # a row per partition
    ends = ends.select("part", F.lag("last").over(parts).alias("above"), F.lead("first").over(parts).alias("below"))
    inside = Window.partitionBy("part").orderBy("place")
    return (
        ordered.join(ends, "part")
        .withColumn("above", F.coalesce(F.lag("prefix").over(inside), "above"))
        .withColumn("below", F.coalesce(F.lead("prefix").over(inside), "below"))
        .where("prefix = above or prefix = below")
        .select("sid", "i")
    )
