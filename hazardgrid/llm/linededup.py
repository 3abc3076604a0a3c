"""Line dedup over all documents: the first document keeps a line, later ones lose it.

Lines travel as hashes with document and position, never as text. They are
range-partitioned by hash and sorted by document and position, so that one pass
streams first occurrences. A hash range that holds far more lines than its share
has a hot line in it; its lines are dealt to slices by document, and only the
first document of each slice is compared again. The outcome per document is a
keep bitmap, run-length coded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardgrid.llm.batches import stored

_NO_ID = -(1 << 63)
WHITE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hash ranges whose sizes are compared, slices of a hot one, and how far above the mean it lies.
RANGE_BITS, SLICES, HOT = 12, 64, 4.0


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), _UPPER, _UPPER.lower())


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _runs(lines: Column, dropped: Column) -> Column:
    """Runs [start, end) of kept positions, from the sorted dropped ones."""
    n = F.size(lines)
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(n))
    pairs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))
    return F.filter(pairs, lambda r: r["start"] < r["end"])


def keep_bitmaps(
    spark: SparkSession,
    docs: DataFrame,
    min_chars: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(rid, tk, dropped): sorted positions of the lines a row of ``docs`` loses.

    Rows that lose nothing are absent; a row is known by its id and text hash.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("rid"),
        F.xxhash64(F.col(text_col)).alias("tk"),
        F.posexplode(F.transform(split_lines(F.col(text_col)), line_key)).alias("pos", "key"),
    ).where(F.col("rid").isNotNull() & (F.length("key") >= min_chars))
    lines = stored(
        spark, rows.select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(7), "key").alias("g"), "rid", "tk", "pos"), "lines"
    )
    part = F.shiftrightunsigned("h", 64 - RANGE_BITS)
    sizes = lines.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # 2^RANGE_BITS rows at most
    mean = sum(r["n"] for r in sizes) / (1 << RANGE_BITS)
    hot = [r["part"] for r in sizes if r["n"] > HOT * mean + SLICES]
    is_hot = part.isin(hot) if hot else F.lit(False)
    dealt = lines.select(
        "*", is_hot.alias("hot"), F.when(is_hot, F.pmod(F.xxhash64("rid"), F.lit(SLICES))).otherwise(0).alias("slice")
    )
    ordered = Window.partitionBy("h", "g", "slice").orderBy("rid", "tk", "pos")
    stream = dealt.repartitionByRange("h", "g", "slice").withColumn("first", F.first("rid").over(ordered))
    later = stream.where("rid > first").select("rid", "tk", "pos")
    if hot:
        heads = stream.where("hot and rid = first").select("h", "g", "rid", "tk", "pos")
        least = heads.groupBy("h", "g").agg(F.min("rid").alias("first"))
        again = heads.join(least, ["h", "g"]).where("rid > first").select("rid", "tk", "pos")
        later = later.union(again)
    return later.distinct().groupBy("rid", "tk").agg(F.sort_array(F.collect_list("pos")).alias("dropped"))


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with llm_lines, llm_dropped (counts), llm_runs (keep bitmap) and llm_kept (text)."""
    marked = docs.withColumns(
        {
            "llm_rid": F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)),
            "llm_tk": F.xxhash64(F.col(text_col)),
        }
    )
    bits = bitmaps.select(F.col("rid").alias("llm_rid"), F.col("tk").alias("llm_tk"), F.col("dropped").alias("llm_bits"))
    joined = marked.join(bits, ["llm_rid", "llm_tk"], "left")
    cut = joined.withColumn("llm_all", split_lines(F.col(text_col))).withColumn(
        "llm_runs", _runs(F.col("llm_all"), F.coalesce("llm_bits", F.array().cast("array<int>")))
    )
    kept = F.flatten(
        F.transform("llm_runs", lambda r: F.slice(F.col("llm_all"), r["start"] + 1, r["end"] - r["start"]))
    )
    return cut.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size("llm_all").cast("bigint").alias("llm_lines"),
        F.coalesce(F.size("llm_bits"), F.lit(0)).cast("bigint").alias("llm_dropped"),
        "llm_runs",
        F.when(F.col("llm_bits").isNull(), F.coalesce(F.col(text_col), F.lit("")))
        .otherwise(F.array_join(kept, "\n"))
        .alias("llm_kept"),
    )


def dedup_lines(
    spark: SparkSession,
    docs: DataFrame,
    min_chars: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with its lines counted, its keep bitmap and the text that stays.

    A line is compared by its stripped, A-Z-folded form. Forms of ``min_chars``
    code points or more that stand in two documents or more are dropped
    everywhere but in the smallest id, where every occurrence stays.

    Defined cases: a null or empty text is one empty line; a null id neither
    drops nor loses a line; rows that share an id are one document; columns of
    any name are kept, except that llm_* ones are replaced; an empty table
    gives an empty one; a very long text is split and joined again in the row
    that holds it, only hashes and positions of its lines are shuffled. Lines are
    known by 128 bits of hash.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("llm_")])
    return apply_bitmaps(docs, keep_bitmaps(spark, docs, min_chars, id_col, text_col), id_col, text_col)
