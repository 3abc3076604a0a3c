"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks.

Sizes are words. A source's target is its weight's share of all words, at most
``ceiling`` times its own; what is cut off is shared again by weight. Sources
below the ceiling compete for blocks of ``block`` words: the highest quotients
weight / (2k - 1) win. A source's quota is passed down to shards of bounded size
the same way, and inside a shard, where documents stand in seeded order, the
selected blocks are spread evenly from a seeded start. The words taken from a
document follow from its place in closed form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardgrid.llm.batches import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a table of sources or shards is broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 10_000
#: Words of a shard, and shards of a source at most (then they grow instead).
SHARD_WORDS, MAX_SHARDS = 1 << 16, 4096


def _sized_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    small = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, keys)


def _seats(rows: DataFrame, group: str | None, seats: str, weight: str, tie: str, out: str) -> DataFrame:
    """Sainte-Lague: ``seats`` of each group to its rows by highest quotient weight / (2k - 1).

    With divisor d every row has floor(weight / d + 1/2) seats. Summed up, that
    differs from total weight / d by half the number of rows at most, which
    bounds the seats of each row from both sides; only those in between
    (two or three a row on average) are ranked.
    """
    everyone = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    total, n = F.sum(weight).over(everyone), F.count("*").over(everyone)
    big = lambda c: c.cast("decimal(38,0)")

    def near(sign: int) -> Column:
        doubled = F.greatest(F.lit(2) * F.col(seats) + F.lit(sign) * F.col("_n"), F.lit(0))
        halves = big(F.col(weight)) * doubled + big(F.col("_total"))
        return F.floor(halves / (2 * big(F.col("_total")))).cast("bigint")

    bounded = (
        rows.withColumns({"_total": total, "_n": n})
        .withColumn("_low", F.when(F.col("_total") > 0, near(-1)).otherwise(0))
        .withColumn("_high", F.when(F.col("_total") > 0, near(1)).otherwise(0))
    )
    bounded = bounded.withColumn("_open", F.col(seats) - F.sum("_low").over(everyone))
    keys = [group] if group else []
    claims = bounded.select(
        *keys, tie, "_open", F.col(weight).alias("_w"), F.explode(F.expr("sequence(_low + 1, greatest(_high, _low) + 1)")).alias("_k")
    ).withColumn("_q", F.col("_w").cast("double") / (2 * F.col("_k") - 1).cast("double"))
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("_q"), tie, "_k")
    won = (
        claims.withColumn("_rank", F.row_number().over(order))
        .where("_rank <= _open and _w > 0")
        .groupBy(*keys, tie)
        .agg(F.count("*").alias("_more"))
    )
    return bounded.join(won, [*keys, tie], "left").select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col("_low") + F.coalesce("_more", F.lit(0))).alias(out)
    )


def _number(text: Column) -> Column:
    """The first 32 bits of an MD5 digest as a number."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("bigint")


def _source(name: Column) -> Column:
    """A source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit(""))


def plan_mix(
    spark: SparkSession,
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    ceiling: int = 3,
    block: int = 64,
    seed: str = "mix-1",
    shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row of ``docs``: doc_id, tk, source, size, source_size, target, taken and the
    terms of its selection (passes, place, blocks, chosen, turn).

    ``taken`` is passes x size plus the words of the selected blocks. Sources
    in code point order, null last, weigh ``weights`` in turn.

    Defined cases: a null or empty text has size 0 and takes 0; a null source
    is a source of its own; a null id is ordered as an empty one; repeated rows
    are documents of their own; a source without words has target 0; an empty
    table gives an empty one; a very long text is counted in the row that holds it,
    a source's text of any length is cut into blocks by positions alone; columns
    other than id, text and source are ignored, whatever their names. A source's
    taken words differ from its target by about a block and by half a block per
    shard on average.
    """
    sized = stored(
        spark,
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.xxhash64(F.col(text_col)).alias("tk"),
            F.col(source_col).cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("turn_key"),
        ),
        "sized",
    )
    every = Window.partitionBy(F.lit(0))
    big = lambda c: F.col(c).cast("decimal(38,0)")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("sno") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sno", F.row_number().over(every.orderBy(F.asc_nulls_last("source"))))
        .withColumn("w", weight.cast("bigint"))
        .withColumn("full", F.col("source_size") * ceiling)
    )
    # From the tightest ceiling on: a source is cut if its share of what is left exceeds its ceiling.
    tight = every.orderBy((F.col("full") / F.col("w")).asc(), F.asc("sno"))
    before, onward = tight.rowsBetween(Window.unboundedPreceding, -1), tight.rowsBetween(0, Window.unboundedFollowing)
    sources = (
        sources.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(onward))
        .withColumn("cut", big("left") * big("w") >= big("full") * big("w_left"))
    )
    rest = Window.partitionBy("cut")
    sources = sources.withColumns(
        {
            "words": F.when(F.col("cut"), F.col("full")).otherwise(
                F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("cut"), F.col("full"))).over(every), F.lit(0))
            ),
            "w_rest": F.sum("w").over(rest),
        }
    ).withColumn(
        "target",
        F.when(F.col("cut"), F.col("full").cast("double")).otherwise(
            (F.col("w") * F.col("words")).cast("double") / F.col("w_rest").cast("double")
        ),
    )
    sources = sources.withColumn("competes", F.when(F.col("cut"), 0).otherwise(F.col("w")))
    open_words = F.max(F.when(~F.col("cut"), F.col("words"))).over(every)
    sources = sources.withColumn("seats", F.floor(F.coalesce(open_words, F.lit(0)) / block).cast("bigint"))
    sources = _seats(sources, None, "seats", "competes", "sno", "quota")
    sources = stored(
        spark,
        sources.select(
            F.coalesce("source", F.lit("")).alias("s_key"),
            F.col("source").isNull().alias("s_null"),
            "sno",
            "source_size",
            "target",
            "cut",
            "quota",
            F.greatest(F.least(F.ceil(F.col("source_size") / shard_words), F.lit(MAX_SHARDS)), F.lit(1)).cast("bigint").alias("shards"),
        ),
        "sources",
    )
    keyed = sized.withColumns({"s_key": F.coalesce("source", F.lit("")), "s_null": F.col("source").isNull()})
    placed = _sized_join(keyed, sources, ["s_key", "s_null"]).withColumn(
        "shard", F.pmod(_number(F.col("turn_key")), F.col("shards"))
    )
    of_source = Window.partitionBy("sno")
    shards = (
        placed.groupBy("sno", "shard")
        .agg(F.sum("size").alias("length"), F.first("quota").alias("quota"), F.first("cut").alias("cut"))
        .withColumn("blocks", F.ceil(F.col("length") / block).cast("bigint"))
        .withColumn("all_blocks", F.sum("blocks").over(of_source))
        .withColumn("quota", F.when(F.col("cut"), ceiling * F.col("all_blocks")).otherwise(F.least("quota", ceiling * F.col("all_blocks"))))
        .withColumn("passes", F.when(F.col("all_blocks") > 0, F.expr("quota div all_blocks")).otherwise(0))
        .withColumn("seats", F.col("quota") - F.col("passes") * F.col("all_blocks"))
    )
    shards = _seats(shards, "sno", "seats", "blocks", "shard", "chosen")
    start = F.md5(F.concat_ws(":", F.lit(seed), F.col("sno").cast("string"), F.col("shard").cast("string")))
    shards = stored(
        spark,
        shards.select(
            "sno",
            "shard",
            "passes",
            "blocks",
            "chosen",
            F.when(F.col("blocks") > 0, F.pmod(_number(start), F.col("blocks"))).otherwise(0).alias("turn"),
        ),
        "shards",
    )
    order = Window.partitionBy("sno", "shard").orderBy("turn_key", "tk", "size")
    placed = placed.withColumn("place", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    joined = _sized_join(placed, shards, ["sno", "shard"])
    extra = selected_before(F.col("place") + F.col("size"), block) - selected_before(F.col("place"), block)
    return joined.select(
        "doc_id",
        "tk",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + F.when(F.col("size") > 0, extra).otherwise(0)).cast("bigint").alias("taken"),
        "passes",
        "place",
        "blocks",
        "chosen",
        "turn",
    )


def _chosen_before(j: Column) -> Column:
    """How many of the first j blocks are selected: ``chosen`` spread evenly over ``blocks`` from ``turn`` on."""
    share = lambda x: F.floor((x * F.col("chosen")) / F.col("blocks"))
    return F.when(F.col("blocks") > 0, share(j + F.col("turn")) - share(F.col("turn"))).otherwise(0).cast("bigint")


def selected_before(x: Column, block: int) -> Column:
    """Words of selected blocks in front of position x of the shard."""
    j = F.floor(x / block).cast("bigint")
    own = _chosen_before(j + 1) - _chosen_before(j)
    return _chosen_before(j) * block + own * (x - j * block)


def mix_documents(
    spark: SparkSession,
    docs: DataFrame,
    block: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The mixed corpus in the columns of ``docs``: one row per pass over a document.

    Full passes return the text unchanged. A last pass that selects only some
    of the words returns these, joined by one space. Documents of which nothing
    is taken are left out; documents without words are left out, too.
    """
    plan = plan_mix(spark, docs, block=block, id_col=id_col, text_col=text_col, **options)
    rid = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    same = Window.partitionBy("llm_rid", "llm_tk", "llm_source")
    plan = plan.where("taken > 0").select(
        rid.alias("llm_rid"), F.col("tk").alias("llm_tk"), _source(F.col("source")).alias("llm_source"), "size", "taken", "passes", "place", "blocks", "chosen", "turn"
    )
    plan = plan.withColumn("llm_no", F.row_number().over(same.orderBy("place")))
    plan = plan.select(*[F.col(c).alias(c if c.startswith("llm_") else f"llm_{c}") for c in plan.columns])
    own = docs.drop(*[c for c in docs.columns if c.startswith("llm_")])
    rows = own.withColumns(
        {
            "llm_rid": F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))),
            "llm_tk": F.xxhash64(F.col(text_col)),
            "llm_source": _source(F.col(options.get("source_col", "source"))),
        }
    )
    rows = rows.withColumn("llm_no", F.row_number().over(same.orderBy(F.lit(0))))
    joined = rows.join(plan, ["llm_rid", "llm_tk", "llm_source", "llm_no"])
    part = F.col("llm_taken") - F.col("llm_passes") * F.col("llm_size")
    whole = F.col("llm_passes") + F.when(part == F.col("llm_size"), 1).otherwise(0)
    times = F.array_repeat(F.lit(True), whole.cast("int"))
    piece = F.when((part > 0) & (part < F.col("llm_size")), F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>"))
    out = joined.withColumn("llm_whole", F.explode(F.concat(times, piece)))
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    share = lambda x: F.floor((x * F.col("llm_chosen")) / F.col("llm_blocks"))

    def chosen(_, i):
        j = F.floor((F.col("llm_place") + i) / block) + F.col("llm_turn")
        return share(j + 1) > share(j)

    cut = F.array_join(F.filter(words, chosen), " ")
    return out.select(
        *[
            F.when(F.col("llm_whole"), F.col(text_col)).otherwise(cut).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in own.columns
        ]
    )
