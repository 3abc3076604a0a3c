"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. One binary classifier per bit tells,
from byte trigrams, on which side of the bit a text's language lies: the log
odds of its trigrams under the languages with and without the bit. A text is
given the language whose codeword costs the least logistic loss over all bits,
each weighed by how far its two sides are apart. A text whose best two
codewords cost nearly the same is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardgrid.llm import words

#: Trigram buckets, and documents per language that are learned from (expected).
BUCKETS, TRAIN_DOCS = 1 << 16, 4000
#: More languages than this get drawn codewords of a few bits per doubling.
DENSE, BITS = 32, 20
#: Trigrams that a text counts for at most; a longer text's odds are averaged to as many, so
#: that its score tells how uniform its language is and not how long it is.
EVIDENCE = 20
#: Every this many-th document by crc32 of its id is held out.
FOLDS = 5
#: What no language is given to.
UNKNOWN = "und"

# Byte classes: letters without case, bytes of longer characters, and one class for all else.
_CLASS = np.zeros(256, np.uint32)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, 155)


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: all distinct splits for a few languages, Hadamard rows for
    more, and for many the drawn code whose least distance is largest."""
    if n <= 5:
        columns = [c for c in product([1, -1], repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int64).reshape(len(columns), n).T if columns else np.ones((n, 0), np.int64)
    if n > DENSE:
        rng = np.random.default_rng(n)
        drawn = [rng.choice([-1, 1], (n, BITS * (n - 1).bit_length())) for _ in range(16)]
        return max(drawn, key=lambda c: -np.max(c @ c.T - 2 * len(c[0]) * np.eye(n)))
    order = 1
    matrix = np.ones((1, 1), np.int64)
    while order < 2 * n:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
        order *= 2
    rows = matrix[1 : n + 1]
    split = np.abs(rows.sum(axis=0)) < n
    return np.unique(rows[:, split] * rows[0, split], axis=1)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    codes: np.ndarray  # languages x bits, +1 or -1
    odds: np.ndarray  # bits x buckets
    weights: np.ndarray  # bits


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigram bucket at every byte (bucket 0 where there is none) and n+1 byte offsets."""
    wide = pa.large_string()
    edge, end, nothing = (pa.scalar(x, wide) for x in (" ", "  ", ""))
    padded = pc.binary_join_element_wise(edge, texts.fill_null("").cast(wide), end, nothing)
    data, offsets = words.text_buffer(padded)
    small = data.copy()
    upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    small[upper] += 0x20
    c = _CLASS[small]
    code = np.zeros(len(c), np.uint32)
    code[:-2] = (c[:-2] * np.uint32(160) + c[1:-1]) * np.uint32(160) + c[2:]
    code[offsets[1:] - 1] = 0
    code[offsets[1:] - 2] = 0
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    bucket[(bucket == 0) & (code > 0)] = 1
    return bucket, offsets


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        _, sizes = words.text_buffer(batch.column("text"))
        for i, j in words.chunks(sizes):
            bucket, offsets = _grams(batch.column("text")[i:j])
            for lang in set(langs[i:j].tolist()):
                rows = np.repeat(langs[i:j] == lang, np.diff(offsets))
                part = np.bincount(bucket[rows], minlength=BUCKETS)
                totals[lang] = totals.get(lang, 0) + part
    for lang, total in totals.items():
        hit = np.flatnonzero(total)
        yield pa.record_batch(
            {
                "lang": pa.array([lang] * len(hit), pa.string()),
                "bucket": pa.array(hit, pa.int32()),
                "n": pa.array(total[hit], pa.int64()),
            }
        )


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text is divisible by the number of folds; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def fit(
    docs: DataFrame,
    train_docs: int = TRAIN_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learn from rows that are not held out and have id, text and language.

    Of each language some ``train_docs`` documents are taken by a hash of their
    id (all, if there are fewer). Every label is a language, however rare; the model
    grows with their number.
    What meets on the driver is a count per language and bucket.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").count().collect()  # a row per language
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model((), np.ones((0, 0), np.int64), np.zeros((0, BUCKETS)), np.zeros(0))
    million = 1_000_000
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(million, train_docs * million // r["count"] + 1))])
    draw = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(million))
    sample = rows.where(draw < rate[F.col("lang")]).select("text", "lang")
    found = sample.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    counts = np.zeros((len(languages), BUCKETS))
    place = {lang: k for k, lang in enumerate(languages)}
    at = np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)
    counts[at, np.asarray(table.column("bucket"))] = np.asarray(table.column("n"))
    counts[:, 0] = 0  # padding and text without letters
    shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    bits = codes.shape[1]
    odds, weights = np.zeros((bits, BUCKETS)), np.zeros(bits)
    for b in range(bits):
        yes, no = shares[codes[:, b] > 0].mean(axis=0), shares[codes[:, b] < 0].mean(axis=0)
        odds[b] = np.log(yes / no)
        middle = (yes + no) / 2
        weights[b] = (yes * np.log(yes / middle) + no * np.log(no / middle)).sum()
    odds[:, 0] = 0
    return Model(tuple(languages), codes, odds, weights / weights.mean() if bits and weights.any() else weights + 1)


def decide(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language (index), score and the loss by which the next one is worse, per text."""
    bucket, offsets = _grams(texts)
    n = len(offsets) - 1
    loss = np.zeros((n, len(model.languages)))
    grams = np.add.reduceat((bucket > 0).astype(np.int64), offsets[:-1])
    scale = np.minimum(1.0, EVIDENCE / np.maximum(grams, 1))
    for b in range(model.codes.shape[1]):
        margin = np.add.reduceat(model.odds[b][bucket], offsets[:-1]) * scale
        for sign in (1, -1):
            cost = model.weights[b] * np.logaddexp(0, -sign * margin)
            loss[:, model.codes[:, b] == sign] += cost[:, None]
    best = loss.argmin(axis=1)
    ordered = np.sort(loss, axis=1)
    gap = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(n, np.inf)
    score = 1 / np.exp(np.minimum(ordered[:, :1] - ordered, 0)).sum(axis=1)
    return best, score, gap


def _predict(model: Model, margin: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            texts = batch.column("llm_text")
            _, sizes = words.text_buffer(texts)
            for i, j in words.chunks(sizes):
                letter = np.asarray(batch.column("llm_letter")[i:j].to_pylist(), dtype=bool)
                if model.languages:
                    best, score, gap = decide(model, texts[i:j])
                else:
                    best, score, gap = np.zeros(j - i, int), np.zeros(j - i), np.zeros(j - i)
                    letter[:] = False
                best = np.where(letter, best, len(model.languages))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k)[i:j] for k in range(len(names))]
                    + [
                        pa.array(known[best].tolist(), pa.string()),
                        pa.array(np.where(letter, score, 0.0)),
                        pa.array(letter & (gap < margin)),
                    ],
                    [*names, "llm_lang", "llm_score", "llm_ambiguous"],
                )

    return run


def predict(docs: DataFrame, model: Model, margin: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with llm_lang, llm_score and llm_ambiguous. Only the text decides.

    The score is the best codeword's share of exp(-loss), from 1 / languages to
    1; a text is ambiguous if the next codeword's loss is less than ``margin``
    above. Columns of any name are kept, except that llm_* ones are replaced.
    """
    own = docs.drop(*[c for c in docs.columns if c.startswith("llm_")])
    text = F.col(text_col).cast("string")
    rows = own.select(
        "*",
        F.coalesce(text, F.lit("")).alias("llm_text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("llm_letter"),
    )
    schema = T.StructType(list(own.schema.fields))
    schema = schema.add("llm_lang", "string").add("llm_score", "double").add("llm_ambiguous", "boolean")
    return rows.mapInArrow(_predict(model, margin, own.columns), schema)


def identify(
    docs: DataFrame,
    model: Model | None = None,
    margin: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    Defined cases: a text that is null or has no letter is ``und`` with score
    0, and so is any text if nothing could be learned; with one language learned
    all others have that; a null id is not held out and not learned from;
    repeated rows are judged alike; other columns are ignored, whatever their
    names; an empty table gives an empty one; all trigrams of a very long text count,
    averaged to the weight of ``EVIDENCE`` of them.
    """
    model = model or fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    return predict(rows, model, margin).select(
        "doc_id",
        "held_out",
        F.col("llm_lang").alias("lang_pred"),
        F.col("llm_score").alias("score"),
        F.col("llm_ambiguous").alias("ambiguous"),
    )
