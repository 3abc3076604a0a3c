"""Quality rules: per-document counts, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm.batches import stored
from hazardgrid.llm.linededup import line_key, split_lines

#: White space between words, as a pattern class.
_WHITE = r"[\x20\x09-\x0D]"
_BLACK = r"[^\x20\x09-\x0D]"
_SYMBOLS = r"[#*$%&|<>]"
#: Words of a repeated window.
WIDTH = 5


def _repeats(ordered: Column) -> Column:
    """Places in an array of (h, i), ordered, whose h equals a neighbour's."""
    last = F.size(ordered) - 1
    same = lambda a, b: ordered[a]["h"] == ordered[b]["h"]
    return F.filter(
        F.sequence(F.lit(0), last),
        lambda k: ((k > 0) & same(F.greatest(k - 1, F.lit(0)), k)) | ((k < last) & same(k, F.least(k + 1, last))),
    )


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with llm_n_words, llm_word_chars, llm_n_symbols, llm_n_dup_lines, llm_n_repeat_words.

    All of it is computed inside the row. Repeated windows are looked for in
    sorted order, and only in texts that have any.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("llm_text", text)
    # Each array is a column of its own before it is indexed, else it would be
    # built anew for every element.
    rows = rows.withColumn(
        "llm_hashes",
        F.transform(F.filter(F.split("llm_text", _WHITE + "+", -1), lambda w: w != ""), lambda w: F.xxhash64(w)),
    ).withColumn("llm_n_words", F.size("llm_hashes").cast("bigint"))
    windows = F.transform(
        F.sequence(F.lit(0), F.col("llm_n_words").cast("int") - WIDTH),
        lambda i: F.xxhash64(*[F.col("llm_hashes")[i + k] for k in range(WIDTH)]),
    )
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("llm_windows", F.when(F.col("llm_n_words") >= WIDTH, windows).otherwise(none))
    rows = rows.withColumn("llm_again", F.size(F.array_distinct("llm_windows")) < F.size("llm_windows"))
    pairs = F.transform("llm_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("llm_sorted", F.when(F.col("llm_again"), F.sort_array(pairs)))
    rows = rows.withColumn("llm_picked", F.when(F.col("llm_again"), _repeats(F.col("llm_sorted"))))
    rows = rows.withColumn(
        "llm_places", F.sort_array(F.transform("llm_picked", lambda k: F.col("llm_sorted")[k]["i"]))
    )
    gaps = F.zip_with(
        "llm_places",
        F.slice("llm_places", F.lit(2), F.greatest(F.size("llm_places"), F.lit(1))),
        lambda a, b: F.coalesce(F.least(b - a, F.lit(WIDTH)), F.lit(WIDTH)),
    )
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    rows = rows.withColumn(
        "llm_lines", F.filter(F.split("llm_text", "\n", -1), lambda line: line.rlike(_BLACK))
    )
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        "llm_n_words",
        (F.length("llm_text") - F.regexp_count("llm_text", F.lit(_WHITE))).cast("bigint").alias("llm_word_chars"),
        F.regexp_count("llm_text", F.lit(_SYMBOLS)).cast("bigint").alias("llm_n_symbols"),
        (F.size("llm_lines") - F.size(F.array_distinct("llm_lines"))).cast("bigint").alias("llm_n_dup_lines"),
        F.when(F.col("llm_again"), covered).otherwise(0).cast("bigint").alias("llm_n_repeat_words"),
    )


def removed_words(
    spark: SparkSession,
    docs: DataFrame,
    max_share: float,
    min_docs: int,
    id_col: str,
    text_col: str,
    host_col: str,
) -> DataFrame:
    """(rid, tk, host, gone): words of a row in lines that stand in too many documents of its host.

    A line is above the limit if more than ``min_docs`` documents and more than
    ``max_share`` of the host's documents hold it. The host's first document
    with the line keeps it, so that no content vanishes from the corpus.
    """
    host = F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit(""))
    ids = docs.select(
        F.col(id_col).cast("bigint").alias("rid"), F.xxhash64(F.col(text_col)).alias("tk"), host.alias("host")
    )
    lines = stored(
        spark,
        docs.select(
            F.col(id_col).cast("bigint").alias("rid"),
            F.xxhash64(F.col(text_col)).alias("tk"),
            host.alias("host"),
            F.explode(split_lines(F.col(text_col))).alias("line"),
        )
        .where(F.col("rid").isNotNull() & F.col("line").rlike(_BLACK))
        .select(
            "rid",
            "tk",
            "host",
            F.xxhash64(line_key(F.col("line"))).alias("h"),
            F.xxhash64(F.lit(7), line_key(F.col("line"))).alias("g"),
            F.regexp_count("line", F.lit(_BLACK + "+")).alias("words"),
        ),
        "lines",
    )
    sizes = ids.where("rid is not null").groupBy("host").agg(F.count_distinct("rid").alias("docs"))
    held = lines.select("host", "h", "g", "rid").distinct().groupBy("host", "h", "g")
    held = held.agg(F.count("*").alias("n"), F.min("rid").alias("first")).where(F.col("n") > min_docs)
    above = held.join(sizes, "host").where(F.col("n") > F.col("docs") * max_share)
    gone = (
        lines.join(above.select("host", "h", "g", "first"), ["host", "h", "g"])
        .where("rid > first")
        .groupBy("rid", "tk", "host")
        .agg(F.sum("words").alias("gone"))
    )
    # Each row of a repeated document has brought its lines.
    again = ids.groupBy("rid", "tk", "host").agg(F.count("*").alias("rows")).where("rows > 1")
    return gone.join(again, ["rid", "tk", "host"], "left").select(
        "rid", "tk", "host", F.expr("gone div coalesce(rows, 1)").alias("gone")
    )


def judge(
    spark: SparkSession,
    docs: DataFrame,
    max_share: float = 0.02,
    min_docs: int = 50,
    max_removed: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed, n_line_words, kept.

    ``n_line_words`` are the words in lines above the limit; a document that
    loses more than ``max_removed`` of its words is depleted and not kept, nor
    is one that fails the base rules (fewer than 10 words, or more than a fifth
    of them in repeated windows).

    Defined cases: a null text is empty and fails; a null host is a host of its
    own; a row without id has base rules only; rows that share an id count as
    one document of a host; an empty table gives an empty one; a very long text's
    words are counted in the row that holds it, its lines become rows; columns
    other than id, text and host are ignored, whatever their names.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("host"))
    gone = removed_words(spark, own, max_share, min_docs, "doc_id", "text", "host")
    host = F.coalesce(F.concat(F.lit("="), F.col("host").cast("string")), F.lit(""))
    keyed = own.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tk"), host.alias("host"), "text"
    )
    counts = base_counts(keyed).drop("text")
    joined = counts.join(
        gone.select(F.col("rid").alias("doc_id"), "tk", "host", "gone"), ["doc_id", "tk", "host"], "left"
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        joined.select(
            "doc_id",
            *[F.col(f"llm_{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            F.coalesce("gone", F.lit(0)).cast("bigint").alias("n_line_words"),
        )
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_line_words") <= max_removed * F.col("n_words")))
    )
