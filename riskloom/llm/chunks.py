"""Texts as chunks that a byte-level tokenizer encodes one by one.

A text is cut before every space. A byte-level tokenizer starts a new word there too,
unless the space stands between two white-space characters (or at the end behind
one); a text with such a place is one chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_UNSURE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}] (?:[\s\p{Z}\x{85}\x{1c}-\x{1f}]|\z)"


def text_runs(texts: list[str], most_chars: int) -> Iterator[tuple[int, int]]:
    """Positions of runs of texts of a bounded number of characters (or one longer text)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


class ChunkCache:
    """Ids of chunks that were met lately, as flat arrays: about 40 bytes a chunk, looked up all at once.

    ``encode`` gives the serialized ids (unsigned 32-bit, little-endian) of new
    chunks. Beyond ``most`` chunks, those that more than one call has met are kept,
    or if they are too many, those of the last call.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int):
        self.encode, self.most = encode, most
        self.forget()

    def forget(self) -> None:
        self.keys = pa.array([], pa.large_string())
        self.sizes = np.zeros(0, np.int64)
        self.values = np.zeros(0, np.uint32)
        self.calls = np.zeros(0, np.int32)

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Position of each chunk among the keys, -1 if it is not there."""
        return pc.fill_null(pc.index_in(chunks, value_set=self.keys), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def ids_of(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, size) of each of the distinct chunks in the array of values that comes third."""
        at = self._places(chunks)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = chunks.take(pa.array(new))
            data = self.encode(fresh.to_pylist())
            at[new] = len(self.keys) + np.arange(len(new))
            self.keys = pa.concat_arrays([self.keys, fresh])
            self.sizes = np.append(self.sizes, np.fromiter(map(len, data), np.int64, len(data)) // 4)
            self.values = np.append(self.values, np.frombuffer(b"".join(data), "<u4"))
            self.calls = np.append(self.calls, np.zeros(len(new), np.int32))
        self.calls[at] += 1
        begins = np.cumsum(self.sizes) - self.sizes
        out = begins[at], self.sizes[at], self.values
        if len(self.keys) > self.most:
            stay = np.flatnonzero(self.calls > 1)
            if len(stay) > self.most // 2:
                stay = at
            self.values = self.values[spread(begins[stay], self.sizes[stay])]
            self.keys, self.sizes, self.calls = self.keys.take(pa.array(stay)), self.sizes[stay], np.ones(len(stay), np.int32)
        return out


def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all elements of runs, run by run."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def gathered(texts: list[str], first: Callable[[list[str]], list[bytes]], later: ChunkCache) -> list[np.ndarray]:
    """Ids of every text, from the ids of its chunks.

    ``first`` encodes the chunks that start a text, ``later`` chunks given without
    the space before them; each is asked once for a chunk, however often it occurs.
    """
    column = pa.array(texts, pa.large_string())
    unsure = np.flatnonzero(pc.match_substring_regex(column, _UNSURE).to_numpy(zero_copy_only=False))
    cut = pc.split_pattern(column, " ")
    starts = cut.offsets.to_numpy()
    coded = cut.flatten().dictionary_encode()
    at = coded.indices.to_numpy().astype(np.int64)
    heads = coded.dictionary.take(pa.array(at[starts[:-1]])).to_pylist()
    for i in unsure:
        heads[i] = texts[i]
    # chunks that stand first only, or in a text that is encoded whole, are not asked for
    used = np.ones(len(at), bool)
    used[starts[:-1]] = False
    whole = np.zeros(len(texts), bool)
    whole[unsure] = True
    used[np.repeat(whole, np.diff(starts))] = False
    met = np.zeros(len(coded.dictionary), bool)
    met[at[used]] = True
    wanted = np.flatnonzero(met)
    place = np.zeros(len(met), np.int64)
    place[wanted] = np.arange(len(wanted))
    begins, sizes, values = later.ids_of(coded.dictionary.take(pa.array(wanted)))
    data = first(heads)
    head_sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
    begins = np.append(begins, len(values) + np.cumsum(head_sizes) - head_sizes)
    values = np.append(values, np.frombuffer(b"".join(data), "<u4"))
    at = place[at]
    at[starts[:-1]] = len(wanted) + np.arange(len(texts))
    lengths = np.zeros(len(at), np.int64)
    lengths[used] = sizes[at[used]]
    lengths[starts[:-1]] = head_sizes
    ids = values[spread(begins[at], lengths)]
    bounds = np.append(0, np.cumsum(lengths))[starts]
    return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
