"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each
character; a Viterbi pass carries the best score and the number of pieces of
that best segmentation, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardgrid.llm import pieces, words
from hazardgrid.llm.memo import WordMemo

# Fixed value: what an unknown character costs beyond the worst piece.
UNKNOWN_PENALTY = 10.0


class Counter:
    """Piece counts of texts under a unigram vocabulary.

    Tie rule: of equally good segmentations of a prefix, the one whose last
    piece is longest stays. Scores add up in double precision. A character
    that no single-character piece covers may be unknown; it counts its UTF-8
    bytes with byte fallback and, without it, one per run.
    """

    def __init__(self, model: pieces.Model):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        normal = model.normal()
        for text, i in normal.items():
            self.automaton.add_word(text, (len(text), model.scores[i]))
        if normal:
            self.automaton.make_automaton()
        self.empty = not normal
        self.single = {t for t in normal if len(t) == 1}
        self.unknown = min(model.scores) - UNKNOWN_PENALTY
        self.fallback = bool(model.bytes_from)
        self.model = model
        self.by_unit = self.fallback and pieces.splits_before_space(model)
        self.memo = WordMemo(self._count_units)

    def count(self, text: str) -> int:
        """Pieces of a text whose spaces are already marked."""
        n = len(text)
        best: list[float] = [0.0] + [-np.inf] * n
        pieces_to = [0] * (n + 1)
        unknown_end = [False] * (n + 1)
        matches = iter(()) if self.empty else self.automaton.iter(text)
        end, found = next(matches, (n, None))
        for at in range(n):
            to = at + 1
            top, count = -np.inf, 0
            while end == at:
                size, score = found
                total = best[to - size] + score
                if total > top:
                    top, count = total, pieces_to[to - size] + 1
                end, found = next(matches, (n, None))
            if text[at] not in self.single and best[at] + self.unknown > top:
                top = best[at] + self.unknown
                if self.fallback:
                    count = pieces_to[at] + len(text[at].encode())
                else:
                    count = pieces_to[at] + (not unknown_end[at])
                    unknown_end[to] = True
            best[to], pieces_to[to] = top, count
        return pieces_to[n]

    def _count_units(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        values = [self.count(u.decode().replace(" ", pieces.SPACE)) for u in found]
        return np.array(values, np.uint32), np.ones(len(values), np.int64)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of pieces of every text."""
        if not self.by_unit:
            lead = pieces.SPACE if self.model.dummy_prefix else ""
            return np.array([self.count(lead + t.replace(" ", pieces.SPACE)) if t else 0 for t in texts], np.int64)
        data, starts, ends, first = pieces.units(texts, self.model)
        each, _ = self.memo.spread(self.memo.find(data, starts, ends))
        return np.diff(np.concatenate([[0], np.cumsum(each, dtype=np.int64)])[first])


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(pieces.load(path))


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            _, offsets = words.text_buffer(texts)
            for i, j in words.chunks(offsets):
                counts = counter.counts(texts[i:j].to_pylist())
                yield pa.record_batch({"doc_id": batch.column("doc_id")[i:j], "n_tokens": pa.array(counts)})

    return run


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens under the unigram reading of the model's pieces.

    Defined cases: a null or empty text has no tokens; ids may be null or
    repeat; other columns are ignored, whatever their names; an empty table gives
    an empty one; a very long text's pieces are counted unit by unit.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(_run(model_path), "doc_id bigint, n_tokens bigint")
