"""Token ids of documents in a binary file format.

A shard file is a sequence of segments, each followed by a newline byte (what
Spark's text writer puts behind a value; the writer's commit protocol keeps the
files whole when executors are lost). All numbers are little-endian 64-bit:

    magic, shard, segment, documents, ids, words, blocks, literals   header
    documents x doc_id, documents x length
    (blocks + 1) x word offset, words, literals                      Simple-8b

Within a shard segments and documents ascend by doc_id, and so do the shards.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardgrid.llm import simple8b, words
from hazardgrid.llm.batches import drop_at_exit, run_folder, stored
from hazardgrid.llm.memo import WordMemo

MAGIC = int.from_bytes(b"S8B-IDS1", "little")
HEADER = 8
#: Ids in a segment (a longer document makes one alone) and segments in a file.
SEGMENT_IDS, FILE_SEGMENTS = 1 << 18, 16
#: Stands for a null id; such documents come first.
_NO_ID = -(1 << 63)

# Byte classes between which that pattern always splits: letters, digits (each
# alone) and marks other than the apostrophe. Longer characters but the letters
# of Latin-1 stay in class 0, next to which nothing is cut.
_KIND = np.zeros(256, np.uint8)
for _c in range(0x21, 0x7F):
    _KIND[_c] = 1 if chr(_c).isalpha() else 2 if chr(_c).isdigit() else 3
_KIND[ord("'")] = 0

_PLAIN = re.compile(
    rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[%s]+"
    % re.escape(bytes(np.flatnonzero(_KIND == 3).astype(np.uint8)))
)

# Fixed value: the split pattern of tokenizers that drop white space and never join across it.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class BatchTokenizer:
    """Ids of texts by a tokenizers file, exactly as its ``encode`` gives them.

    If the file splits at white space and drops it, a text's ids are those of
    its words in order, and likewise of letters, digits and marks inside a
    word, so each distinct part is encoded once. Parts are separated by a special token, which the library never joins with its
    neighbours. Lower-casing beforehand saves words; it is done only within
    Latin-1, where it commutes with the library's own normalization.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_word = self._drops_space(spec)
        if self.by_word:
            self.mark = self.special[0]
            self.mark_id = self.tokenizer.token_to_id(self.mark)
            self.lower = any(n["type"] == "Lowercase" for n in spec["normalizer"]["normalizers"])
            size = self.tokenizer.get_vocab_size()
            self.ends_word = np.array([str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)])
            self.memo = WordMemo(self._encode_words)

    def _drops_space(self, spec: dict) -> bool:
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        kinds = {n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])}
        return bool(
            steps
            and steps[0].get("pattern", {}).get("Regex") == _WORD_PATTERN
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and kinds <= {"NFC", "Replace", "Lowercase"}
            and spec.get("post_processor") is None
            and spec["model"].get("end_of_word_suffix") == "</w>"
            and self.special
            and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
            and all(t.startswith("<|") and " " not in t for t in self.special)
        )

    def _encode_words(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Parts that the pattern takes whole end with a word-end piece, so they can be
        encoded together, a space apart; other parts are set apart by the special token."""
        plain = np.array([_PLAIN.fullmatch(w) is not None for w in found], dtype=bool)
        sizes = np.zeros(len(found), np.int64)
        text = [w.decode() for w, p in zip(found, plain) if p]
        joined = [" ".join(text[i : i + 100]) for i in range(0, len(text), 100)]
        ids = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        whole = np.concatenate([np.empty(0, np.uint32), *ids])
        sizes[plain] = np.diff(np.concatenate([[-1], np.flatnonzero(self.ends_word[whole])]))
        rest = self._whole(self.mark.join(w.decode() for w, p in zip(found, plain) if not p))
        if not plain.all():
            cuts = np.concatenate([[-1], np.flatnonzero(rest == self.mark_id), [len(rest)]])
            sizes[~plain] = np.diff(cuts) - 1
        out = np.empty(int(sizes.sum()), np.uint32)
        own = np.repeat(plain, sizes)
        out[own], out[~own] = whole, rest[rest != self.mark_id]
        return out, sizes

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and n+1 offsets."""
        if not self.by_word:
            each = [self._whole(t) for t in texts]
            return np.concatenate([np.empty(0, np.uint32), *each]), np.cumsum([0, *map(len, each)])
        direct = {k: self._whole(t) for k, t in enumerate(texts) if "<|" in t}
        ready = ["" if k in direct else self._prepared(t) for k, t in enumerate(texts)]
        data, offsets = words.text_buffer(pa.array(ready, pa.large_string()))
        starts, ends, _ = words.spans(data, offsets)
        cuts = self._cuts(data, offsets)
        starts, ends = (np.sort(np.concatenate([x, cuts])) for x in (starts, ends))
        ids, bounds = self.memo.spread(self.memo.find(data, starts, ends))
        bounds = bounds[np.searchsorted(starts, offsets)]
        if not direct:
            return ids, bounds
        each = [direct.get(k, ids[a:b]) for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
        return np.concatenate(each), np.cumsum([0, *map(len, each)])

    @staticmethod
    def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places inside words where the pattern always splits."""
        kind = _KIND[data]
        pair = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & ((data[1:] & 0x5F) != 0x17))
        kind[pair] = kind[pair + 1] = 1
        before, after = kind[:-1], kind[1:]
        cut = (before > 0) & (after > 0) & ((before != after) | (before == 2))
        cut = np.flatnonzero(cut) + 1
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        return cut[~edge[cut]]

    def _prepared(self, text: str) -> str:
        if self.lower:
            try:
                text.encode("latin-1")
                return text.lower()
            except UnicodeEncodeError:
                pass
        return text


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> BatchTokenizer:
    """One per worker process: what a task learned serves the next one."""
    return BatchTokenizer(path)


def pack(shard: int, segment: int, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    coded, offsets, literals = simple8b.encode(ids)
    head = [MAGIC, shard, segment, len(doc_ids), len(ids), len(coded), len(offsets) - 1, len(literals)]
    parts = [
        np.array(head, np.uint64).astype("<u8"),
        np.asarray(doc_ids, "<i8"),
        np.asarray(lengths, "<i8"),
        np.asarray(offsets, "<i8"),
        coded.astype("<u8"),
        literals.astype("<u8"),
    ]
    return b"".join(p.tobytes() for p in parts)


def unpack(content: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, segment, doc_ids, lengths, ids) of every segment of a file."""
    at = 0
    while at < len(content):
        head = np.frombuffer(content, "<i8", HEADER, at)
        if head[0] != MAGIC:
            raise ValueError("not a token id file")
        _, shard, segment, docs, n, coded, blocks, literals = head.tolist()
        at += HEADER * 8
        parts = []
        for size, kind in ((docs, "<i8"), (docs, "<i8"), (blocks + 1, "<i8"), (coded, "<u8"), (literals, "<u8")):
            parts.append(np.frombuffer(content, kind, size, at))
            at += size * 8
        at += 1
        yield shard, segment, parts[0], parts[1], simple8b.decode(parts[3], parts[2], parts[4], n)


def _write(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        shard = TaskContext.get().partitionId()
        segment, held_docs, held_ids, held = 0, [], [], 0

        def segment_bytes():
            lengths = np.concatenate([x for _, x in held_docs])
            docs = np.concatenate([x for x, _ in held_docs])
            return pack(shard, segment, docs, lengths, np.concatenate(held_ids))

        for batch in batches:
            doc_ids = np.asarray(batch.column("rid"))
            texts = batch.column("text").fill_null("")
            _, offsets = words.text_buffer(texts)
            for i, j in words.chunks(offsets):
                ids, bounds = tokenizer.encode(texts[i:j].to_pylist())
                lengths = np.diff(bounds)
                if end_id is not None:
                    ids = np.insert(ids, bounds[1:], end_id)
                    lengths = lengths + 1
                held_docs.append((doc_ids[i:j], lengths))
                held_ids.append(ids)
                held += len(ids)
                if held >= SEGMENT_IDS:
                    yield pa.record_batch({"segment": pa.array([segment_bytes()], pa.binary())})
                    segment, held_docs, held_ids, held = segment + 1, [], [], 0
        if held_docs:
            yield pa.record_batch({"segment": pa.array([segment_bytes()], pa.binary())})

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            for shard, segment, docs, lengths, ids in unpack(content.as_buffer()):
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.record_batch(
                    {
                        "rid": pa.array(docs, pa.int64()),
                        "shard": pa.array(np.full(len(docs), shard)),
                        "segment": pa.array(np.full(len(docs), segment)),
                        "before": pa.array(ends - lengths),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )


def write_ids(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text and write the ids in ascending id order to ``folder``.

    Documents are range-partitioned and sorted by id; each partition is one
    shard and streams its segments. Defined cases: a null text is empty, an
    empty text has the end id only; null ids come first; rows that share an id
    follow each other in order of their text; an empty table gives no segment; a
    very long text makes a segment of its own that is held at once; columns other
    than id and text are ignored, whatever their names.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID)).alias("rid"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = rows.repartitionByRange("rid").sortWithinPartitions("rid", "text")
    (
        ordered.mapInArrow(_write(tokenizer_path, end_id), "segment binary")
        .select(F.col("segment").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", FILE_SEGMENTS)
        .option("lineSep", "\n")
        .text(folder)
    )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of ``folder``: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: of the earlier shards, of
    the shard's earlier segments, of the segment's earlier documents. Only a total
    per shard, that is per partition written, meets in one task.
    """
    found = stored(
        spark,
        spark.read.format("binaryFile")
        .load(folder)
        .select("content")
        .mapInArrow(
            _read, "rid bigint, shard bigint, segment bigint, before bigint, n_tokens bigint, ids_crc32 bigint"
        ),
        "documents",
    )
    parts = found.groupBy("shard", "segment").agg(F.sum("n_tokens").alias("n"))
    before = Window.unboundedPreceding, -1
    shards = parts.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = shards.select("shard", F.sum("n").over(Window.orderBy("shard").rowsBetween(*before)).alias("earlier"))
    inside = F.sum("n").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(*before))
    zero = F.lit(0).cast("bigint")
    base = parts.join(shards, "shard").select(
        "shard", "segment", (F.coalesce("earlier", zero) + F.coalesce(inside, zero)).alias("base")
    )
    return found.join(base, ["shard", "segment"]).select(
        F.when(F.col("rid") != _NO_ID, F.col("rid")).alias("doc_id"),
        (F.col("base") + F.col("before")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_ids(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int | None = 1) -> DataFrame:
    """Write the ids of ``docs`` to the shared folder and read them back."""
    folder = run_folder(spark, "ids")
    write_ids(spark, docs, tokenizer_path, folder, end_id)
    drop_at_exit(spark, folder)
    return read_ids(spark, folder)
