"""The parts of a SentencePiece model file that the operators use."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from hazardgrid.llm import words

SPACE = "▁"
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class Model:
    kind: int
    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    unknown: int
    bytes_from: tuple[int, ...]  # id of every byte's piece; empty without fallback
    dummy_prefix: bool

    def normal(self) -> dict[str, int]:
        return {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == NORMAL}


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    """Read a model; what this engine does not express is refused."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    spec, trained = proto.normalizer_spec, proto.trainer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models with the identity normalizer are supported")
    if trained.treat_whitespace_as_suffix:
        raise ValueError("white space as a suffix is not supported")
    kinds = tuple(p.type for p in proto.pieces)
    if USER_DEFINED in kinds:
        raise ValueError("user-defined pieces are not supported")
    texts = tuple(p.piece for p in proto.pieces)
    names = {t: i for i, (t, k) in enumerate(zip(texts, kinds)) if k == BYTE}
    fallback = tuple(names[f"<0x{b:02X}>"] for b in range(256)) if trained.byte_fallback else ()
    return Model(
        trained.model_type,
        texts,
        tuple(p.score for p in proto.pieces),
        kinds,
        kinds.index(UNKNOWN),
        fallback,
        spec.add_dummy_prefix,
    )


def splits_before_space(model: Model) -> bool:
    """No piece has a space mark behind another character, so none crosses into a new word."""
    return not any(SPACE in t.lstrip(SPACE) for t in model.normal())


def units(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes, start and end of every unit, and n+1 unit offsets of the texts.

    A unit is a run of spaces with the characters up to the next space or line
    end, or a line end; no piece crosses a unit's edges. The dummy prefix is
    part of the text here, and a space mark in a text is a space. Line ends
    split units only if no longer piece has one.
    """
    lead = " " if model.dummy_prefix else ""
    texts = [t.replace(SPACE, " ") for t in texts]
    data, offsets = words.text_buffer(pa.array([lead + t if t else "" for t in texts], pa.large_string()))
    space = data == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    if not any("\n" in t and len(t) > 1 for t in model.texts):
        line = data == 0x0A
        start |= line
        start[1:] |= line[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return data, starts, ends, np.searchsorted(starts, offsets)
