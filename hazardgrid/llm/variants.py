"""Spelling variants: near words found through an index of variable-length grams.

Words are counted once. A dictionary holds all shortest grams and every extension
of a gram that more than ``often`` words contain, so frequent grams are replaced by
longer, rarer ones. A word is decomposed into the longest dictionary grams at its
positions that no earlier one covers. One edit affects at most one of two grams that
lie apart: for such a pair the word's bound is one, so a near word is in the list of
one of both for sure, and only the lists of the rarest pair are merged. A gram
before the edit keeps all that stands before it, one behind it all that follows; so
lists are kept by gram, its outer part and the length of the words in them.
Candidates are then verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm.batches import stored

#: Lengths of grams; a word's own grams are at most half as long as the word.
SHORTEST, LONGEST = 2, 8
#: A gram in more words than this gets longer ones beside it.
OFTEN = 32
#: Distinct words that a task holds before it hands its counts on.
HELD = 1 << 17
#: Letters of a text that are looked at at once.
PIECE = 1 << 20
LETTERS = re.compile(r"[a-zÀ-ÿ]+")
#: One run in so many loses a code point.
TYPO_MOD = 97


def runs(text: bytes, least: int) -> Counter:
    """Maximal runs of ``least`` letters or more with A-Z lower-cased, and how often they occur."""
    text = text.lower().decode("utf-8", "replace")
    long_runs = re.compile(f"{LETTERS.pattern[:-1]}{{{least},}}")
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text) and LETTERS.match(text, end - 1):
            end = LETTERS.match(text, end - 1).end()
        found.update(long_runs.findall(text, at, end))
        at = end
    return found


def _counted(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out():
            return pa.record_batch({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column("rid"), batch.column("text").cast(pa.binary())):
                rid = doc_id.as_py()
                crc = zlib.crc32(b":" if rid is None else b"%d:" % rid)
                for word, n in runs(text.as_py() or b"", least).items():
                    h = zlib.crc32(word.encode(), crc)
                    if not h % TYPO_MOD:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                        if len(word) < least:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def decompose(grams: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """A word's own grams (start, end, words that hold it) of all dictionary grams in it:
    the longest one a position, and none inside an earlier one.
    """
    longest: dict[int, tuple[int, int]] = {}
    for start, end, often in grams:
        if end > longest.get(start, (0, 0))[0]:
            longest[start] = (end, often)
    own, reach = [], 0
    for start in sorted(longest):
        end, often = longest[start]
        if end > reach:
            own.append((start, end, often))
            reach = end
    return own


def rarest_apart(own: list[tuple[int, int, int]]) -> tuple[int, int]:
    """End of the first and start of the second of the rarest two grams that lie apart.

    The first gram of a word and its last one always do, as none is over half of it.
    """
    best, first, k = None, None, 0
    for start, _, often in own:
        while own[k][1] <= start:  # ends ascend like starts do
            if first is None or (own[k][2], -own[k][1]) < (first[2], -first[1]):
                first = own[k]
            k += 1
        if first is not None and (best is None or first[2] + often < best[0]):
            best = (first[2] + often, first[1], start)
    return best[1:]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word the end of its first gram and the start of its second one."""
    for batch in batches:
        flat = zip(*(batch.column(c).flatten().to_pylist() for c in ("starts", "ends", "oftens")))
        counts = batch.column("starts").value_lengths().to_pylist()
        chosen = [rarest_apart(decompose(list(islice(flat, n)))) for n in counts]
        yield pa.record_batch(
            {
                "word": batch.column("word"),
                "n": batch.column("n"),
                "head": pa.array([c[0] for c in chosen], pa.int32()),
                "tail": pa.array([c[1] for c in chosen], pa.int32()),
            }
        )


def vocabulary(docs: DataFrame, least_size: int = 5, least_n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the distinct words of all texts with their counts."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("rid"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    counted = rows.mapInArrow(_counted(least_size), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def near_words(spark: SparkSession, words: DataFrame, often: int = OFTEN) -> DataFrame:
    """(word, n, other, other_n) for every two words one edit apart, both ways round.

    ``words``: distinct (word, n). Words of fewer than ``2 * SHORTEST`` code points
    have no two grams apart and are refused.
    """
    whole = words.where(F.expr(f"length(word) >= {2 * SHORTEST} or raise_error('a word is too short')"))
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.floor(F.length("word") / 2).cast("int")))
    starts = F.sequence(F.lit(0), F.length("word") - F.col("size"))
    grams = (
        whole.select("word", "n", F.explode(sizes).alias("size"))
        .select("word", "n", "size", F.explode(starts).alias("start"))
        .select("word", "n", "start", "size", F.expr("substring(word, start + 1, size)").alias("gram"))
    )
    counts = stored(spark, grams.groupBy("gram").agg(F.count("*").alias("often")), "grams")
    longer = counts.where(F.length("gram") > SHORTEST).withColumn("stem", F.expr("left(gram, length(gram) - 1)"))
    stems = counts.where(F.col("often") > often).select(F.col("gram").alias("stem"))
    dictionary = longer.join(stems, "stem", "left_semi").select("gram", "often")
    dictionary = dictionary.union(counts.where(F.length("gram") == SHORTEST))
    own = F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("end"), "often"))
    pairs = (
        grams.join(dictionary, "gram")
        .groupBy("word", "n")
        .agg(own.alias("g"))
        .select("word", "n", F.col("g.start").alias("starts"), F.col("g.end").alias("ends"), F.col("g.often").alias("oftens"))
        .mapInArrow(_pairs, "word string, n bigint, head int, tail int")
    )
    # A list's key is a hash: a collision only adds a candidate.
    head = lambda end, size: F.xxhash64(F.lit("head"), F.expr(f"left(word, {end})"), size)
    tail = lambda start, size: F.xxhash64(F.lit("tail"), F.expr(f"substring(word, {start} + 1)"), size)
    size = F.length("word")
    probes = pairs.select(
        "word",
        "n",
        F.explode(F.array(*[key for d in (-1, 0, 1) for key in (head("head", size + d), tail("tail", size + d))])).alias("list"),
    )
    cuts = F.sequence(F.lit(SHORTEST), size - 1)
    lists = whole.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "word", F.explode(cuts).alias("cut"))
    lists = lists.select("other", "other_n", F.explode(F.array(head("cut", size), tail("length(word) - cut", size))).alias("list"))
    return (
        probes.join(lists, "list")
        .where(F.levenshtein("word", "other", 1) == 1)
        .select("word", "n", "other", "other_n")
        .distinct()
    )


def _roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form; each step doubles the forms followed.

    A form is at least twice as frequent as its word, so forms never lead in a circle
    and 2^6 steps are more than any chain has.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            spark,
            reached.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")
            ),
            "roots",
        )
        reached = moved.select("word", "root")
        if not moved.where("went").limit(1).count():
            return reached


def group_variants(
    spark: SparkSession,
    docs: DataFrame,
    least_size: int = 5,
    least_n: int = 3,
    often: int = OFTEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per word of ``docs``: word, form, root, n, n_near, form_n.

    A word is a maximal run of ASCII letters and U+00C0 to U+00FF with A-Z lower-cased;
    if 97 divides the CRC-32 of ``<doc_id>:<run>``, the run counts without the code
    point at that number modulo its length. Words have at least ``least_size`` code
    points and ``least_n`` occurrences. Near words differ by one code point inserted,
    deleted or replaced. ``form`` is the most frequent near word (ties: the smallest in
    code-point order) if it is at least twice as frequent, ``root`` the last of the
    forms' chain.

    Defined cases: a null or empty text has no words; a null id is an empty text
    before the colon; every row counts, repeated or not; a very long text is looked at
    in pieces cut between runs, its distinct words are held at once; a word of any
    length takes part whole; an empty table gives an empty one; columns other than id
    and text are ignored, whatever their names.
    """
    known = stored(spark, vocabulary(docs, least_size, least_n, id_col, text_col), "words")
    near = near_words(spark, known, often)
    # The largest count first, then the smallest word.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    judged = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    named = stored(
        spark,
        known.join(judged, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.other")).alias("form"),
            F.when(-F.col("best.less") >= 2 * F.col("n"), -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(spark, named.where("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
