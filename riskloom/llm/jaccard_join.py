"""N-gram Jaccard join: rare-first prefixes with length, position and suffix filters.

A document is its set of word n-grams (hashed to 64 bits). All sets share one order,
rarest n-gram first, so two sets of similarity t have an n-gram in common among the
first ``n - ceil(t * n) + 1`` of each. Only those prefixes are joined:

1. Each task sorts the n-grams of a shard of documents and deals them by hash range
   (compressed arrays, one row for each shard and range). A range counts the documents
   of its n-grams and returns those held by two documents or more to their shards; an
   n-gram that many documents of a shard hold travels as a count, its documents apart.
   An n-gram of one document cannot be shared, so it takes a place in the prefix and
   nothing else: most documents end here, with a prefix of such n-grams.
2. Equal sets are one class, and its smallest row stands for it.
3. Prefix n-grams with set size, position and the suffix's count vector (n-grams after
   that position in each part of the hash space) are sorted by (n-gram, size, row).
   A pair meeting at an n-gram is kept if the sizes fit (length filter), if enough
   n-grams follow (position filter), and if the count vectors leave room for enough
   common ones (suffix filter). The first common n-gram of a similar pair passes all.
4. Pairs are made distinct, joined with both sets and verified once.

Long lists of an n-gram, as large groups of near copies make them, first meet in stars
and with a few neighbours only, then neighbours of different components in orders drawn anew. What
these connect needs no more pairs; rows of such lists that are still in different
components then all meet, in blocks of bounded size. So links form spanning
forests and no two similar texts end in different components; ``every=True`` makes all
pairs of class representatives instead.

Results by case: null, empty and wordless texts have no n-gram and link with nothing;
a text with fewer words than an n-gram has its whole sequence as the only one; equal
sets link, so repeated rows share their component; a null identifier is in its
component but never names it; no rows give no rows; a long text is read a megabyte at
a time, its distinct hashes are held; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.components import components
from riskloom.session import materialize

WORDS = 5            # words of an n-gram
PERCENT = 80         # least similarity: 100 * intersection >= PERCENT * union
SHARD_GRAMS = 4_000_000   # n-grams of a shard; a single long document may go over
RANGE_GRAMS = 4_000_000   # n-grams of a hash range, about
COMMON = 16          # an n-gram of more documents of a shard than this travels as a count
PARTS = 16           # parts of the hash space in a count vector
SCAN_RUN = 128       # longest list in which all pairs meet at once
BLOCK_ROWS = 2048    # rows of a block when a longer list is finished in pairs of blocks
NEAR = 4             # neighbours that a row of a longer list meets at once, besides the star's centre
PARTNERS = 8         # pairs of longer lists that are verified for a row at once
MEETINGS = 1         # most rounds in which neighbours of long lists meet before the rest is finished in blocks
WORTH = 8            # a round is followed by another one while one in so many of its pairs is similar

_CHUNK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_APART = np.uint32(0xFFFFFFFF)


# ---- sets -----------------------------------------------------------------------------------


def gram_hashes(text: str | bytes | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of a text's word n-grams, ascending; A-Z lower-cased."""
    data = (text.encode() if isinstance(text, str) else text or b"").lower()
    parts, before, start = [], [], 0
    while start < len(data):
        end = start + _CHUNK
        if end < len(data):
            m = _SPACE.search(data, end)
            end = m.start() if m else len(data)
        now = before + data[start:end].split()
        if len(now) >= words:
            grams = map(b" ".join, zip(*(now[k:] for k in range(words))))
            parts.append(np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64)))
        # the next chunk's first n-gram starts at the words that have not begun one
        before = now[max(0, len(now) - words + 1):]
        start = end
    if not parts:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(before))] if before else [], np.uint64)
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length by byte planes, compressed; an ascending first column is stored as steps."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in (first, *columns[1:])]
    return zstandard.compress(b"".join(planes), 1)


def _unpacked(data: bytes, *types: type) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    widths = [np.dtype(t).itemsize for t in types]
    n, at, out = len(raw) // sum(widths), 0, []
    for t, w in zip(types, widths):
        out.append(np.ascontiguousarray(raw[at:at + n * w].reshape(w, n).T).view(t).ravel())
        at += n * w
    out[0] = np.cumsum(out[0], dtype=types[0])
    return out


# kind 0: a document (a = shard, b = its place there); 1: n-grams of a range; 2: documents of common n-grams
_DEALT = "kind int, range long, shard long, place long, row long, id long, n long, d1 long, d2 long, data binary"
_DEALT_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("range", pa.int64()), ("shard", pa.int64()), ("place", pa.int64()), ("row", pa.int64()),
    ("id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("data", pa.binary()),
])


def _dealt(words: int, bits: int):
    """Documents, and their n-grams sorted and cut by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 24
        docs, sets, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_pylist(docs, _DEALT_SCHEMA)
            grams = np.concatenate(sets)
            if not len(grams):
                return
            place = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(x) for x in sets])
            order = np.argsort(grams, kind="stable")
            grams, place = grams[order], place[order]
            heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            counts = np.diff(np.append(heads, len(grams)))
            common = np.repeat(counts > COMMON, counts)
            if common.any():
                yield pa.RecordBatch.from_pylist(
                    [{"kind": 2, "range": shard, "shard": shard, "data": _packed(grams[common], place[common])}], _DEALT_SCHEMA
                )
            many = np.ones(len(grams), np.uint32)
            many[heads] = np.where(counts > COMMON, counts, 1)
            place[common] = _APART
            keep = ~common
            keep[heads] = True
            grams, place, many = grams[keep], place[keep], many[keep]
            top = (grams >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(grams), np.int64)
            cuts = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
            for s, e in zip(cuts, np.append(cuts[1:], len(top))):
                row = {"kind": 1, "range": int(top[s]), "shard": shard, "data": _packed(grams[s:e], place[s:e], many[s:e])}
                yield pa.RecordBatch.from_pylist([row], _DEALT_SCHEMA)

        for b in batches:
            texts = b.column(2).cast(pa.large_string()).cast(pa.large_binary())
            for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts):
                grams = gram_hashes(text.as_py(), words)
                digest = xxhash.xxh3_128_digest(grams.tobytes())
                d1, d2 = np.frombuffer(digest, np.int64).tolist()
                docs.append({"kind": 0, "range": row, "shard": shard, "place": len(sets), "row": row, "id": doc_id, "n": len(grams), "d1": d1, "d2": d2})
                sets.append(grams)
                held += len(grams)
                if held >= SHARD_GRAMS or len(docs) >= SHARD_GRAMS:
                    yield from flush()
                    shard, docs, sets, held = shard + 1, [], [], 0
        if docs:
            yield from flush()

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of each range that two documents or more hold, with that number, back by shard; other kinds pass."""
    now, parts = None, []

    def close() -> Iterator[pa.RecordBatch]:
        grams, place, many = (np.concatenate(c) for c in zip(*(p[1:] for p in parts)))
        shard = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
        order = np.argsort(grams, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(grams[order]) != 0))
        sums = np.add.reduceat(many[order].astype(np.int64), heads)
        df = np.empty(len(grams), np.int64)
        df[order] = np.repeat(sums, np.diff(np.append(heads, len(grams))))
        keep = df > 1
        ends = np.cumsum([len(p[1]) for p in parts])
        for k, e in enumerate(ends.tolist()):
            part = slice(e - len(parts[k][1]), e)
            mine = keep[part]
            if mine.any():
                data = _packed(grams[part][mine], place[part][mine], df[part][mine].astype(np.uint64))
                yield pa.RecordBatch.from_pylist([{"kind": 1, "shard": parts[k][0], "data": data}], _DEALT_SCHEMA)

    for b in batches:
        kinds = b.column(0).to_numpy(zero_copy_only=False)
        if (kinds != 1).any():
            yield b.filter(pa.array(kinds != 1))
        for r in np.flatnonzero(kinds == 1).tolist():
            at, shard = b.column(1)[r].as_py(), b.column(2)[r].as_py()
            if parts and at != now:
                yield from close()
                parts = []
            now = at
            parts.append((shard, *_unpacked(b.column(9)[r].as_py(), np.uint64, np.uint32, np.uint32)))
    if parts:
        yield from close()


# ---- prefixes -------------------------------------------------------------------------------

# kind 0: a prefix n-gram of a document; kind 1: its n-grams held elsewhere too, ascending
_PREFIX = "kind int, gram long, n long, row long, place int, data binary"


def _least_common(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection of sets of these sizes with the least similarity."""
    return -(-percent * (na + nb) // (100 + percent))


def _prefixes(percent: int):
    def of_shard(docs: list[tuple[int, int, int]], lists: list[list[np.ndarray]], common: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if not lists:
            return
        grams, place, df = (np.concatenate(c) for c in zip(*lists))
        apart = place == _APART
        if apart.any():
            known = np.argsort(grams[apart])
            names, counts = grams[apart][known], df[apart][known]
            more, where = (np.concatenate(c) for c in zip(*common))
            at = np.searchsorted(names, more)
            grams, place = np.append(grams[~apart], more), np.append(place[~apart], where)
            df = np.append(df[~apart], counts[at])
        n_of, row_of = np.zeros(1 + int(place.max()), np.int64), np.zeros(1 + int(place.max()), np.int64)
        for p, row, n in docs:
            if p < len(n_of):
                n_of[p], row_of[p] = n, row
        stays = n_of[place] > 0
        grams, place, df = grams[stays], place[stays].astype(np.int64), df[stays]
        order = np.lexsort((grams, df, place))
        grams, place = grams[order], place[order]
        heads = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else []
        for s, e in zip(heads, np.append(heads[1:], len(place)) if len(place) else []):
            n = int(n_of[place[s]])
            first = n - (e - s)                     # n-grams of no other document come first
            last = n - -(-percent * n // 100) + 1   # end of the prefix
            if first >= last:
                continue
            own, row, k = grams[s:e], int(row_of[place[s]]), last - first
            parts = (own & np.uint64(PARTS - 1)).astype(np.int64)
            after = np.bincount(parts, minlength=PARTS) - np.cumsum(parts[:k, None] == np.arange(PARTS), axis=0)
            vectors = after.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(np.zeros(k, np.int32), np.int32(1))), pa.array(np.append(own[:k].view(np.int64), 0)), pa.array(np.full(k + 1, n)),
                    pa.array(np.full(k + 1, row)), pa.array(np.append(np.arange(first, last), 0).astype(np.int32)),
                    pa.array([*(v.tobytes() for v in vectors), _packed(np.sort(own))], pa.binary()),
                ],
                names=["kind", "gram", "n", "row", "place", "data"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, lists, common = None, [], [], []
        for b in batches:
            for kind, shard, place, row, n, data in zip(*(b.column(k).to_pylist() for k in range(6))):
                if shard != now:
                    yield from of_shard(docs, lists, common)
                    now, docs, lists, common = shard, [], [], []
                if kind == 0:
                    docs.append((place, row, n))
                elif kind == 1:
                    lists.append(_unpacked(data, np.uint64, np.uint32, np.uint64))
                else:
                    common.append(_unpacked(data, np.uint64, np.uint32))
        yield from of_shard(docs, lists, common)

    return run


# ---- candidates -----------------------------------------------------------------------------


class _Rows:
    """Rows of prefix n-grams, sorted by n-gram, size and row."""

    def __init__(self, gram, n, row, place, vectors, root):
        self.gram, self.n, self.row, self.place, self.vectors, self.root = gram, n, row, place, vectors, root

    @classmethod
    def of(cls, b: pa.RecordBatch) -> "_Rows":
        num = [b.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        vectors = np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint32).reshape(-1, PARTS).astype(np.int64)
        return cls(*num, vectors, b.column(5).to_numpy(zero_copy_only=False))

    def __len__(self) -> int:
        return len(self.gram)

    def part(self, s) -> "_Rows":
        return _Rows(self.gram[s], self.n[s], self.row[s], self.place[s], self.vectors[s], self.root[s])

    def then(self, other: "_Rows") -> "_Rows":
        mine, more = vars(self), vars(other)
        return _Rows(*(np.concatenate([mine[k], more[k]]) for k in ("gram", "n", "row", "place", "vectors", "root")))

    def similar(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs (of equal n-gram, n of i at most n of j) pass all filters."""
        ok = (100 * self.n[i] >= percent * self.n[j]) & (self.root[i] != self.root[j])
        at = np.flatnonzero(ok)
        i, j = i[at], j[at]
        least = _least_common(self.n[i], self.n[j], percent)
        fits = 1 + np.minimum(self.n[i] - self.place[i], self.n[j] - self.place[j]) - 1 >= least
        at, i, j, least = at[fits], i[fits], j[fits], least[fits]
        fits = 1 + np.minimum(self.vectors[i], self.vectors[j]).sum(axis=1) >= least
        out = np.zeros(len(ok), bool)
        out[at[fits]] = True
        return out


def _pairs_of(rows: _Rows, percent: int, scan: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pairs inside runs of one n-gram (kind 0); of runs longer than ``scan`` only stars and a few neighbours (kind 2)."""
    n = len(rows)
    heads = np.flatnonzero(np.append(True, rows.gram[1:] != rows.gram[:-1])) if n else np.zeros(0, int)
    sizes = np.diff(np.append(heads, n))
    follow = np.repeat(heads + sizes, sizes) - np.arange(n) - 1
    for s, k in zip(heads[sizes > scan], sizes[sizes > scan]):
        hub, i, j = s, [], []
        for at in range(s + 1, s + k):
            if 100 * rows.n[hub] < percent * rows.n[at]:
                hub = at
                continue
            i.append(hub), j.append(at)
        for d in range(1, NEAR + 1):
            i.extend(range(s, s + k - d)), j.extend(range(s + d, s + k))
        i, j = np.array(i, np.int64), np.array(j, np.int64)
        ok = rows.similar(i, j, percent)
        yield 2, i[ok], j[ok]
        follow[s:s + k] = 0
    act, d = np.flatnonzero(follow >= 1), 1
    while len(act):
        for at in range(0, len(act), 1 << 18):  # bounded count vectors in memory
            part = act[at:at + (1 << 18)]
            ok = rows.similar(part, part + d, percent)
            yield 0, part[ok], part[ok] + d
        d += 1
        # sizes ascend inside a run, so a row that is too small for one stays too small for all later ones
        act = act[follow[act] >= d]
        act = act[100 * rows.n[act] >= percent * rows.n[act + d]]


_CANDIDATES = "kind int, a long, b long, na long, nb long, ra long, rb long"


def _pair_rows(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(columns[0]), kind, np.int32)), *(pa.array(c.astype(np.int64)) for c in columns)], names=["kind", "a", "b", "na", "nb", "ra", "rb"]
    )


class _Found:
    """Pairs of rows, made distinct in bounded memory, as the same pair meets at many n-grams."""

    def __init__(self, kind: int):
        self.kind, self.pairs = kind, set()

    def add(self, rows: _Rows, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.pairs.update(zip(*(c.tolist() for c in (rows.row[i], rows.row[j], rows.n[i], rows.n[j], rows.root[i], rows.root[j]))))
        if len(self.pairs) > 200_000:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.pairs:
            yield _pair_rows(self.kind, *np.array(list(self.pairs), np.int64).T)
            self.pairs.clear()


def _candidates(percent: int, scan: int):
    """Pairs (kinds 0 and 2); long n-grams and the partition's first and last n-gram (kind 1), which may go on next door."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, first = None, None

        found = {0: _Found(0), 2: _Found(2)}

        def pairs(rows: _Rows) -> Iterator[pa.RecordBatch]:
            for kind, i, j in _pairs_of(rows, percent, scan):
                yield from found[kind].add(rows, i, j)
            names, counts = np.unique(rows.gram, return_counts=True)
            names = names[counts > scan]
            if len(names):
                zero = np.zeros(len(names), np.int64)
                yield _pair_rows(1, names, zero - 1, zero, zero, zero, zero)

        for b in batches:
            if not b.num_rows:
                continue
            rows = _Rows.of(b)
            rows = rows if left is None else left.then(rows)
            first = rows.gram[0] if first is None else first
            cut = int(np.searchsorted(rows.gram, rows.gram[-1]))  # the last n-gram may go on
            if cut:
                yield from pairs(rows.part(slice(0, cut)))
            left = rows.part(slice(cut, None))
        if left is not None:
            yield from pairs(left)
            ends = np.unique(np.array([first, left.gram[-1]], np.int64))
            zero = np.zeros(len(ends), np.int64)
            yield _pair_rows(1, ends, zero + TaskContext.get().partitionId(), zero, zero, zero, zero)
        for kind in found.values():
            yield from kind.flush()

    return run


def _neighbours(percent: int):
    """Pairs (kind 2) of neighbouring rows of one n-gram whose roots differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Found(2)
        for b in batches:
            rows = _Rows.of(b)
            i = np.flatnonzero(rows.gram[1:] == rows.gram[:-1])
            small = np.where(rows.n[i] <= rows.n[i + 1], i, i + 1)
            large = 2 * i + 1 - small
            ok = rows.similar(small, large, percent)
            yield from found.add(rows, small[ok], large[ok])
        yield from found.flush()

    return run


_JOINED = ("gram", "n", "row", "place", "data", "root")


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, na, nb = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3))
            least = _least_common(na, nb, percent)
            ok, last, set_a = np.zeros(len(a), bool), None, None
            for k, (x, y) in enumerate(zip(b.column(6), b.column(7))):
                if last != a[k]:
                    last, set_a = a[k], _unpacked(x.as_py(), np.uint64)[0]
                ok[k] = len(np.intersect1d(set_a, _unpacked(y.as_py(), np.uint64)[0], assume_unique=True)) >= least[k]
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(ok)) for k in (0, 1, 4, 5)], names=["a", "b", "ra", "rb"])

    return run


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets are similar, with their roots."""
    left = sets.select(F.col("row").alias("a"), F.col("data").alias("set_a"))
    right = sets.select(F.col("row").alias("b"), F.col("data").alias("set_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ra", "rb", "set_a", "set_b")
    return joined.mapInArrow(_verified(percent), "a long, b long, ra long, rb long")


def _distinct_pairs(found: DataFrame) -> DataFrame:
    """Every pair once; of the pairs of long lists a few for each row, drawn by hash, as their rows meet again."""
    # a row's pairs are at most a few for each n-gram of its prefix
    met = found.where("kind = 2").groupBy("b").agg(F.collect_set(F.struct(F.xxhash64("a", "b").alias("draw"), "a", "na", "nb", "ra", "rb")).alias("p"))
    ends = met.select(F.explode(F.slice(F.sort_array("p"), 1, PARTNERS)).alias("p"), "b").select("p.a", "b", "p.na", "p.nb", "p.ra", "p.rb")
    pairs = found.where("kind = 0").select("a", "b", "na", "nb", "ra", "rb").unionByName(ends)
    return pairs.groupBy("a", "b").agg(*(F.first(c).alias(c) for c in ("na", "nb", "ra", "rb")))


def _open_rows(rows: DataFrame) -> DataFrame:
    """Rows of the lists that hold two components or more."""
    apart = rows.groupBy("gram").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("gram")
    # written, so that both sides of later joins are plain exchanges, whose hot n-grams Spark can split
    return materialize(rows.join(apart, "gram", "left_semi"), "open-rows")


def _relabelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows with the roots that edges between roots (ra, rb) lead to."""
    known = materialize(components(edges.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "known-components").withColumnRenamed("root", "new_root")
    return rows.join(known, F.col("root") == F.col("node"), "left").select(
        "gram", "n", "row", "place", "data", F.coalesce("new_root", "root").alias("root")
    )


def _in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Candidates among the rows (with ``root``) of long or split lists: blocks of bounded size meet in pairs."""
    blocks = rows.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("m"))
    placed = rows.join(blocks, "gram").withColumn("i", F.pmod(F.xxhash64("row"), F.col("m")))
    met = placed.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    keyed = met.withColumn("gram", F.xxhash64("gram", F.least("i", "j"), F.greatest("i", "j")))
    ordered = keyed.repartition("gram").sortWithinPartitions("gram", "n", "row").select(*_JOINED)
    # all pairs of a block pair: the scan length is beyond any block
    return ordered.mapInArrow(_candidates(percent, 4 * BLOCK_ROWS), _CANDIDATES)


def similar_pairs(prefixes: DataFrame, percent: int = PERCENT, every: bool = False) -> DataFrame:
    """(a, b): rows of class representatives whose sets are similar; a spanning forest's worth, or every pair."""
    sets = prefixes.where("kind = 1").select("row", "data")
    grams = prefixes.where("kind = 0").select("gram", "n", "row", "place", "data", F.col("row").alias("root"))
    ordered = grams.repartitionByRange("gram", "n", "row").sortWithinPartitions("gram", "n", "row")
    found = materialize(ordered.select(*_JOINED).mapInArrow(_candidates(percent, SCAN_RUN), _CANDIDATES), "gram-pairs")
    new = materialize(_similar(_distinct_pairs(found), sets, percent), "similar-pairs")
    edges = new.select("a", "b")
    unfinished = found.where("kind = 1").groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("parts"))
    unfinished = unfinished.where("least < 0 OR parts > 1").select(F.col("a").alias("gram"))
    rows = grams.join(unfinished, "gram", "left_semi")
    if not every:
        rows = _open_rows(_relabelled(rows, new))
        for turn in range(MEETINGS):
            # in an order drawn anew each time, neighbours of different components meet; what they join needs no pairs later
            mixed = F.xxhash64("row", F.lit(turn))
            met = rows.repartitionByRange("gram", mixed).sortWithinPartitions("gram", mixed).select(*_JOINED)
            tried = materialize(_distinct_pairs(met.mapInArrow(_neighbours(percent), _CANDIDATES)), "neighbour-pairs")
            new = materialize(_similar(tried, sets, percent), "similar-pairs")
            if new.count() * WORTH < tried.count() or not new.count():
                edges = edges.unionByName(new.select("a", "b"))
                break
            edges = edges.unionByName(new.select("a", "b"))
            rows = _open_rows(_relabelled(rows, new))
    more = _distinct_pairs(_in_blocks(rows, percent)).join(edges, ["a", "b"], "left_anti")
    return edges.unionByName(materialize(_similar(more, sets, percent).select("a", "b"), "similar-pairs"))


# ---- documents ------------------------------------------------------------------------------


def shared_grams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Documents (kind 0) and the n-grams they share with others, by shard (kinds 1 and 2), as one written table."""
    text = F.col(text_col).cast("string")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # a word has about six bytes; no fewer ranges than the exchange has partitions
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = math.ceil(math.log2(max(1.0, partitions, size / 6 / RANGE_GRAMS)))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    dealt = rows.mapInArrow(_dealt(words, bits), _DEALT)
    # kinds share the exchange; documents go by row, n-grams by range
    ordered = dealt.repartition(1 << bits, "range").sortWithinPartitions("kind", "range")
    return materialize(ordered.mapInArrow(_counted, _DEALT), "shared-grams")


def prefixes_of(shared: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Prefix n-grams and shared sets of the class representatives, as one written table."""
    stands = shared.where("kind = 0").join(classes.select(F.col("rep").alias("row")), "row", "left_semi")
    rows = stands.select("kind", "shard", "place", "row", "n", F.lit(None).cast("binary").alias("data")).unionByName(
        shared.where("kind > 0").select("kind", "shard", "place", "row", "n", "data")
    )
    ordered = rows.repartition("shard").sortWithinPartitions("shard", "kind")
    return materialize(ordered.mapInArrow(_prefixes(percent), _PREFIX), "gram-prefixes")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, class, component_id), one row per row of ``docs``.

    ``class`` is the smallest row number among rows of an equal set, ``component_id`` the
    smallest identifier that similar sets reach.
    """
    shared = shared_grams(docs, id_col, text_col, words)
    members = shared.where("kind = 0").select("row", "id", "n", "d1", "d2")
    classes = materialize(members.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("row").alias("rep"), F.min("id").alias("least")), "gram-classes")
    linked = materialize(components(similar_pairs(prefixes_of(shared, classes, percent), percent)), "class-components")
    named = classes.join(linked, F.col("rep") == F.col("node"), "left").select("n", "d1", "d2", "rep", "least", F.coalesce("root", "rep").alias("root"))
    named = materialize(named, "class-roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = materialize(named.join(ids, "root").select("n", "d1", "d2", "rep", "component_id"), "class-identifiers")
    some = members.where("n > 0").join(of_class, ["n", "d1", "d2"]).select("id", F.col("n").alias("n_shingles"), F.col("rep").alias("class"), "component_id")
    none = members.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("row").alias("class"), F.col("id").alias("component_id"))
    return some.unionByName(none)
