"""Byte-level BPE on padded numpy matrices.

A text is cut into chunks at spaces that always start a new piece (see ``chunks``),
chunks into pieces by the tokenizer's pattern, and each piece that a task has not met
lately is encoded: pieces are bucketed by length into padded matrices of ids, and in each
round every row merges its leftmost pair of minimum rank; pair ranks come from an
open-addressing hash table, merged rows are compacted, finished rows leave the
matrix. Pieces longer than the widest bucket (thousands of letters without a break)
are merged with a heap, in the same order, so that they do not take one round over
the whole row per merge.

Results by case: a null text counts as empty and has no ids; no rows give no rows;
repeated rows are encoded one by one; a null identifier is kept; other columns are
not read. Special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.chunks import ChunkCache, gathered, spread, text_runs
from riskloom.llm.common import tidy

NO_PAIR = np.int32(2**31 - 1)
WIDTHS = (2, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
MATRIX_CELLS = 1 << 19
CACHED_CHUNKS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of a pair of adjacent ids, looked up by hash with linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        lefts, joins = array("q"), array("i")
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    lefts.append(a << 32 | b)
                    joins.append(rank)
        self.bits = (2 * len(lefts)).bit_length()
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.ranks = np.full(1 << self.bits, NO_PAIR, np.int32)
        keys, ranks_of = np.array(lefts, np.uint64), np.array(joins, np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == 2**64 - 1
            at, first = np.unique(slots[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[at], self.ranks[at] = keys[chosen], ranks_of[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, ranks_of, slots = keys[rest], ranks_of[rest], (slots[rest] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NO_PAIR where there is none or an id is padding (-1)."""
        out = np.full(left.shape, NO_PAIR, np.int32)
        real = (left >= 0) & (right >= 0)
        keys = (left[real].astype(np.uint64) << np.uint64(32)) | right[real].astype(np.uint64)
        found = np.full(len(keys), NO_PAIR, np.int32)
        slots, open_ = self._slots(keys), np.arange(len(keys))
        while len(open_):
            there = self.keys[slots]
            hit = there == keys[open_]
            found[open_[hit]] = self.ranks[slots[hit]]
            go_on = ~hit & (there != 2**64 - 1)
            open_, slots = open_[go_on], (slots[go_on] + 1) & ((1 << self.bits) - 1)
        out[real] = found
        return out


class Codec:
    """Encoder and decoder for one file of ranks and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # token bytes by rank, as one run with offsets
        by_rank = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            by_rank[rank] = token
        self.token_sizes = np.fromiter(map(len, by_rank), np.int64, len(by_rank))
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.pattern = regex.compile(pattern)
        self.later = ChunkCache(lambda chunks: self._chunk_ids([" " + c for c in chunks]), CACHED_CHUNKS)

    # -- pieces

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(p) > WIDTHS[-1]:
                out[i] = self._long(p)
            elif p:
                buckets.setdefault(next(w for w in WIDTHS if len(p) <= w), []).append(i)
            else:
                out[i] = np.zeros(0, np.int32)
        for width, members in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for at in range(0, len(members), step):
                part = members[at:at + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        columns = np.arange(width)
        ids = np.where(columns < lengths[:, None], self.byte_ids[flat], np.int32(-1))
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(pieces))
        out: list[np.ndarray] = [None] * len(pieces)
        while len(row):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), at]
            done = best == NO_PAIR
            if done.any():
                for r, x, n in zip(row[done], ids[done], lengths[done]):
                    out[r] = x[:n].copy()
                live = ~done
                row, ids, rank, lengths, at, best = row[live], ids[live], rank[live], lengths[live], at[live], best[live]
                if not len(row):
                    break
            # merge and compact: ids after the merged pair move left by one
            k = np.arange(len(row))
            take = columns[:-1] + (columns[:-1] > at[:, None])
            ids = np.concatenate([np.take_along_axis(ids, take, 1), np.full((len(row), 1), -1, np.int32)], axis=1)
            ids[k, at] = best
            if width > 2:
                take = columns[:-2] + (columns[:-2] > at[:, None])
                rank = np.concatenate([np.take_along_axis(rank, take, 1), np.full((len(row), 1), NO_PAIR, np.int32)], axis=1)
            lengths = lengths - 1
            before = np.maximum(at - 1, 0)
            rank[k, before] = self.pairs(ids[k, before], ids[k, before + 1])
            after = np.minimum(at, width - 2)
            rank[k, after] = self.pairs(ids[k, after], ids[k, after + 1])
        return out

    def _long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, in order of (rank, position), with a heap and linked positions."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        n = len(ids)
        rank = self.pairs(ids[:-1], ids[1:]).tolist() + [int(NO_PAIR)]
        ids = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(rank) if r != NO_PAIR]
        heapq.heapify(heap)

        def again(i: int) -> None:
            j = after[i]
            joined = self.ranks.get(self.token(ids[i]) + self.token(ids[j])) if j < n else None
            rank[i] = int(NO_PAIR) if joined is None else joined
            if joined is not None:
                heapq.heappush(heap, (joined, i))

        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r or ids[i] < 0:
                continue
            j = after[i]
            ids[i], ids[j], rank[j] = r, -1, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            again(i)
            if before[i] >= 0:
                again(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    # -- texts

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        pieces: dict[str, int] = {}
        parts = [[pieces.setdefault(p, len(pieces)) for p in self.pattern.findall(c)] for c in chunks]
        ids = [x.tobytes() for x in self.encode_pieces([p.encode() for p in pieces])]
        return [b"".join([ids[k] for k in of]) for of in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        return gathered(texts, self._chunk_ids, self.later)

    def token(self, rank: int) -> bytes:
        start = int(self.token_starts[rank])
        return self.token_bytes[start:start + int(self.token_sizes[rank])].tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[spread(self.token_starts[ids], self.token_sizes[ids])].tobytes()

    def joined(self, ids: np.ndarray) -> str:
        """Decimal ids with a space between."""
        return " ".join(map(str, ids.tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker process's codec for a file of ranks, loaded once."""
    key = (path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(path, pattern)
    return _codecs[key]


def texts_of(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


BATCH_CHARS = 1_000_000


def _encoded_runs(c: Codec, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(identifiers, ids) of a few million characters at a time, so that a batch of long texts stays small in memory."""
    try:
        for b in batches:
            texts = texts_of(b.column(1))
            for i, j in text_runs(texts, BATCH_CHARS):
                yield b.column(0).slice(i, j - i), c.encode(texts[i:j])
    finally:
        c.later.forget()  # an idle worker holds the tables alone


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): token ids of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids in _encoded_runs(codec(path, pattern), batches):
            offsets = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int32)
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "id long, ids array<int>")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(id, data): the bytes that the ids of each row stand for; null ids are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            data = [None if x is None else c.decode(np.array(x, np.int32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["id", "data"])

    return tokens.select("id", "ids").mapInArrow(tidy(run), "id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the bytes they decode to.

    Encoding and decoding happen in one task, so that ids do not travel in between.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for keys, ids in _encoded_runs(c, batches):
            yield pa.RecordBatch.from_arrays(
                [
                    keys, pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(c.joined(x).encode()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in ids], pa.string()),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
