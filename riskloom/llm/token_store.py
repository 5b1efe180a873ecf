"""Token-id files with a shared zstandard dictionary and one compressed frame per document.

Layout under a folder, all of it written by Spark (so a lost task is written again
and never half seen):

* ``dictionary``: one row (sha256, data), trained on the serialized ids of a bounded
  sample of documents (``SAMPLE_DOCS`` documents, ``SAMPLE_BYTES`` of each); with too
  few samples to train on, the dictionary is empty and frames stand alone;
* ``shards``: rows of about ``SHARD_BYTES`` with the frames of consecutive documents
  (``frames``), the index (``doc_ids``, ``offsets``, ``counts``), the range of
  identifiers, the dictionary's hash and the ids of the shards before it in its part.

Documents are range-partitioned and sorted by identifier. A document's first position
is the sum over earlier parts, over earlier shards and over earlier index entries, so
no sum runs over documents in one task. A frame is ids as little-endian unsigned
32-bit integers; ``fetch`` reads single documents by their offset.

Results by case: a null text counts as empty and holds the end id alone; a null
identifier comes first; rows that share an identifier are ordered by text; no rows
give an empty store; other columns are not read.

Texts are encoded by the ``tokenizers`` library. A byte-level tokenizer cuts texts
into words before anything else, so a text is cut into chunks where such a tokenizer
always starts a new word, and a chunk is encoded once and kept in a bounded cache. Any
other tokenizer gets whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.llm.chunks import ChunkCache, gathered, text_runs

END_ID = 0
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 32_768
DICTIONARY_BYTES = 65_536
SHARD_BYTES = 1 << 20
LEVEL = 3
CACHED_CHUNKS = 1_000_000
BATCH_CHARS = 12_000_000

# Letters that are one word with the space before them, a mark that is the next one, and
# perhaps a line end, a word of its own before more letters, and the same again.
_PLAIN = re.compile("([A-Za-zß-öø-ʯ]+)([,.]?)(?:\n([A-Za-zß-öø-ʯ]+)([,.]?))?")

_SHARDS = (
    "part int, seq int, first_id long, last_id long, doc_ids array<long>, offsets array<long>, counts array<long>, "
    "n_tokens long, tokens_before long, dict_sha256 string, frames binary"
)


def _serialized(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


class Encoder:
    """A tokenizer file of the ``tokenizers`` library, with special tokens in texts as ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec.get("pre_tokenizer") or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.chunked = plain and not spec.get("normalizer") and all(t.get("special") for t in spec.get("added_tokens") or [])
        if self.chunked:  # the same tokenizer for texts that are one word each
            self.words = Tokenizer.from_file(path)
            self.words.encode_special_tokens = True
            self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.marks = dict(zip(",.\n", self._library([",", ".", "\n"]))) | {"": b""}
        self.chunks = ChunkCache(self._new_chunks, CACHED_CHUNKS)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [_serialized(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks after a space; a word and the same word before a mark or a line end are encoded once."""
        words = {c: b"" for c in chunks if c.isalpha() and c.isascii()}
        lines: dict[str, bytes] = {}
        parts: dict[str, tuple] = {}
        odd: list[str] = []
        fullmatch = _PLAIN.fullmatch
        for c in chunks:
            if c in words:
                continue
            m = fullmatch(c)
            if m is None:
                odd.append(c)
                continue
            parts[c] = p = m.groups()
            words[p[0]] = b""
            if p[2]:
                lines[p[2]] = b""
        words.update(zip(words, self._word_ids([" " + w for w in words])))
        lines.update(zip(lines, self._word_ids(list(lines))))
        whole = dict(zip(odd, self._library([" " + c for c in odd])))
        marks, end = self.marks, self.marks["\n"]
        for c, (word, mark, line, last) in parts.items():
            data = words[word] + marks[mark]
            whole[c] = data + end + lines[line] + marks[last] if line else data
        return [words[c] if c in words else whole[c] for c in chunks]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        return [_serialized(e.ids) for e in self.words.encode_batch_fast(words, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialized ids of whole texts."""
        if not self.chunked:
            return self._library(texts)
        return [ids.tobytes() for ids in gathered(texts, self._library, self.chunks)]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _train(rows: DataFrame, tokenizer_path: str) -> bytes:
    """Dictionary from the documents with the smallest hashes: a bounded sample, the only ids the driver sees."""
    place = F.xxhash64("id")
    narrow = rows.select(place.alias("place")).orderBy("place").limit(SAMPLE_DOCS)
    last = narrow.agg(F.max("place")).first()[0]
    if last is None:
        return b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["" if t is None else t for t in b.column(0).to_pylist()]
            for i, j in text_runs(texts, BATCH_CHARS):
                yield pa.RecordBatch.from_arrays([pa.array([x[:SAMPLE_BYTES] for x in _encoder(tokenizer_path).encode(texts[i:j])], pa.binary())], names=["ids"])

    sample = rows.where(place <= last).select("text").limit(SAMPLE_DOCS).mapInArrow(run, "ids binary")
    samples = sorted(bytes(r.ids) for r in sample.collect() if r.ids)
    try:
        size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
        return zstandard.train_dictionary(size, samples, threads=1).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too small samples
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _shard_rows(tokenizer_path: str, dictionary: bytes, end_id: int):
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("tokens_before", pa.int64()), ("dict_sha256", pa.string()), ("frames", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        packer, encoder = _compressor(dictionary), _encoder(tokenizer_path)
        ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        size = 0

        def shard() -> pa.RecordBatch:
            offsets = np.append(0, np.cumsum([len(f) for f in frames])).tolist()
            known = [i for i in ids if i is not None]
            row = [part, seq, min(known, default=None), max(known, default=None), ids, offsets, counts, sum(counts), before, dict_hash, b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            for i, j in text_runs(texts, BATCH_CHARS):
                for doc_id, data in zip(doc_ids[i:j], encoder.encode(texts[i:j])):
                    data += end
                    ids.append(doc_id), frames.append(packer.compress(data)), counts.append(len(data) // 4)
                    size += len(frames[-1])
                    if size >= SHARD_BYTES:
                        yield shard()
                        seq, before = seq + 1, before + sum(counts)
                        ids, frames, counts, size = [], [], [], 0
        if ids:
            yield shard()

    return run


def write_store(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` to each document and write the store to ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    dictionary = _train(rows, tokenizer_path)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "sha256 string, data binary").coalesce(1).write.parquet(f"{path}/dictionary")
    order = F.col("id").asc_nulls_first()
    ordered = rows.repartitionByRange(order, F.xxhash64("text")).sortWithinPartitions(order, F.xxhash64("text"), "text")
    ordered.mapInArrow(_shard_rows(tokenizer_path, dictionary, end_id), _SHARDS).write.parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return row["sha256"], data


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``base``: the ids of all parts before a shard's (one row a part is summed)."""
    shards = spark.read.schema(_SHARDS).parquet(f"{path}/shards")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    bases = parts.select("part", F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("base"))
    # one row a part: the number of partitions bounds it, and the frames stay where they are
    return shards.join(F.broadcast(bases), "part")


def _read_frames(dict_hash: str, dictionary: bytes, wanted: frozenset | None, keep_ids: bool):
    """Documents of shards; of ``wanted`` identifiers only those frames are decompressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _decompressor(dictionary)
        for b in batches:
            for shard in range(b.num_rows):
                doc_ids, offsets, counts, before, base, used, frames = (b.column(i)[shard].as_py() for i in range(7))
                if used != dict_hash:
                    raise ValueError("a shard was written with another dictionary")
                starts = (base + before + np.append(0, np.cumsum(counts))[:-1]).tolist()
                out: list[list] = [[], [], [], [], []]
                for k, doc in enumerate(doc_ids):
                    if wanted is None or doc in wanted:
                        data = unpack.decompress(frames[offsets[k]:offsets[k + 1]])
                        if len(data) != 4 * counts[k]:
                            raise ValueError(f"document {doc}: the frame does not hold the ids that the index says")
                        for column, value in zip(out, (doc, starts[k], counts[k], zlib.crc32(data), np.frombuffer(data, "<u4").astype(np.int32) if keep_ids else None)):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names=["id", "start", "n_tokens", "ids_crc32", "ids"])

    return run


_READ = ["doc_ids", "offsets", "counts", "tokens_before", "base", "dict_sha256", "frames"]
_ROWS = "id long, start long, n_tokens long, ids_crc32 long, ids array<int>"


def read_store(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document; ids only with ``keep_ids``."""
    return _shards(spark, path).select(*_READ).mapInArrow(_read_frames(*_dictionary(spark, path), None, keep_ids), _ROWS)


def fetch(spark: SparkSession, path: str, ids: Iterable[int]) -> DataFrame:
    """The documents with the given identifiers, ids included: shards by their range, frames by their offset."""
    wanted = frozenset(ids)
    near = F.lit(False)
    for i in wanted:
        near = near | ((F.col("first_id") <= i) & (F.col("last_id") >= i))
    return _shards(spark, path).where(near).select(*_READ).mapInArrow(_read_frames(*_dictionary(spark, path), wanted, True), _ROWS)
