"""Phrase collocations mined with weighted acyclic automata.

Each task reads a shard of words per language, sorts its windows of up to five words
(one begins at every word and ends with its piece) and builds count transducers from the
sorted windows: an arc's weight is the number of windows that pass it, so the weight of
a path is the frequency of that phrase in the shard. States with a single way out of
weight 1 are shared where label and target agree, which folds the long tails of windows
that occur once. Windows of a bounded sample of documents give splitters; a shard has one
transducer for each prefix range between them, and those of one range are united with
their weights summed, a bounded number of windows at a time. What a range keeps are its
frequent paths and the paths along its own ends, which the neighbouring range may share
and which are summed afterwards. A common first word therefore spans many ranges; the
sample decides where ranges begin, never what is counted.

A candidate is then composed with the counts of its parts: every cut asks for the
weights of both sides, a join that Spark splits at hot parts. Products are exact
decimals. A candidate is dropped for a longer one that is as frequent; one word longer
is enough to look at, since a phrase between the two is as frequent as well.

Results by case: null and empty texts have no word, a null language is ``und``; repeated
rows count each time; equal scores go by frequency and then by phrase (byte order); no
rows, or no phrase that is frequent enough, give no rows; a long text is one shard's
worth of words at a time, cut between pieces or words with windows kept whole; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import materialize

LENGTH = 5           # words of the longest phrase
MIN_COUNT = 100      # least frequency of a candidate
BEST = 2000          # phrases a language
ABSORBED = 100       # per cent of a candidate's frequency at which a longer one replaces it
SHARD_WORDS = 600_000      # words of a shard
RANGE_WINDOWS = 1_000_000  # windows of a prefix range, about
MERGE_WINDOWS = 2_000_000  # windows held before they are united
SAMPLE_BYTES = 32_000_000  # text, about, whose windows give the splitters
SAMPLES = 20_000           # windows that reach the driver for it, at most about

# Pieces end at these characters, words at spaces and tabs.
_FOLD = bytearray(bytes(range(256)).lower())
for _c in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_c] = 0x0A
_FOLD[0x09] = 0x20
_FOLD = bytes(_FOLD)
_CHUNK = 1 << 20


# ---- windows --------------------------------------------------------------------------------


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _sorted_sums(columns: list[np.ndarray], counts: np.ndarray, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows in order, with summed counts; labels are below ``size``."""
    bits = max(1, int(size).bit_length())
    per = max(1, 63 // bits)
    keys = []
    for at in range(0, len(columns), per):
        key = columns[at].astype(np.int64)
        for c in columns[at + 1:at + per]:
            key = (key << bits) | c
        keys.append(key)
    order = np.lexsort(keys[::-1])
    head = np.ones(len(order), bool)
    if len(order):
        head[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    starts = np.flatnonzero(head)
    sums = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
    return [c[order[starts]] for c in columns], sums


def _windows(stream: np.ndarray) -> list[np.ndarray]:
    """Labels of the window at every word of a stream (0 ends a piece), padded with 0."""
    n = len(stream)
    long = np.append(stream, np.zeros(LENGTH, stream.dtype))
    at = np.flatnonzero(stream)
    columns, open_ = [stream[at]], np.ones(len(at), bool)
    for k in range(1, LENGTH):
        label = long[at + k]
        open_ &= label > 0
        columns.append(np.where(open_, label, 0))
    return columns


class Bag:
    """Distinct windows in order with counts; labels are 1 + positions in the sorted word list."""

    def __init__(self, words: list[bytes], columns: list[np.ndarray], counts: np.ndarray):
        self.words, self.columns, self.counts = words, columns, counts

    def __len__(self) -> int:
        return len(self.counts)

    @classmethod
    def of_stream(cls, names: list[bytes], stream: np.ndarray) -> "Bag":
        """``stream`` has 0 between pieces, else 1 + position in ``names``."""
        rank = np.zeros(len(names) + 1, np.int32)
        rank[1 + np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)] = np.arange(1, len(names) + 1)
        columns = _windows(rank[stream])
        return cls(sorted(names), *_sorted_sums(columns, np.ones(len(columns[0]), np.int64), len(names) + 1))

    @classmethod
    def union(cls, bags: list["Bag"]) -> "Bag":
        if len(bags) == 1:
            return bags[0]
        words = sorted(set().union(*(b.words for b in bags)))
        at = {w: k + 1 for k, w in enumerate(words)}
        columns: list[list[np.ndarray]] = [[] for _ in range(LENGTH)]
        for b in bags:
            label = np.array([0, *(at[w] for w in b.words)], np.int32)
            for all_, own in zip(columns, b.columns):
                all_.append(label[own])
        counts = np.concatenate([b.counts for b in bags])
        return cls(words, *_sorted_sums([np.concatenate(c) for c in columns], counts, len(words) + 1))

    def part(self, start: int, end: int) -> "Bag":
        """Windows start..end with the words they use."""
        columns = [c[start:end] for c in self.columns]
        label = np.zeros(len(self.words) + 1, np.int32)
        for c in columns:
            label[c] = 1
        label[0] = 0
        used = np.flatnonzero(label)
        label[used] = np.arange(1, len(used) + 1)
        return Bag([self.words[k - 1] for k in used], [label[c] for c in columns], self.counts[start:end])

    def text(self, row: int, length: int = LENGTH) -> bytes:
        return b" ".join(self.words[c[row] - 1] for c in self.columns[:length] if c[row])

    def place(self, splitter: list[bytes]) -> int:
        """Number of windows before the splitter."""
        low, high = 0, len(self)
        for k in range(LENGTH):
            word = splitter[k] if k < len(splitter) else None
            at = bisect_left(self.words, word) if word is not None else -1
            known = word is None or at < len(self.words) and self.words[at] == word
            column = self.columns[k][low:high]
            left = int(np.searchsorted(column, at + 1, "left"))
            if not known:
                return low + left
            low, high = low + left, low + int(np.searchsorted(column, at + 1, "right"))
        return low

    def prefixes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, first window, weight) of the phrases of each length."""
        head = np.zeros(len(self), bool)
        if len(head):
            head[0] = True
        for k, c in enumerate(self.columns):
            head[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(head)
            weight = np.add.reduceat(self.counts, starts) if len(starts) else self.counts[:0]
            some = c[starts] > 0
            yield k + 1, starts[some], weight[some]


# ---- automata -------------------------------------------------------------------------------


def _packed(arrays: list[np.ndarray]) -> bytes:
    planes = [np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(len(a), 8).T).tobytes() for a in arrays]
    return zstandard.compress(np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(planes), 1)


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    lengths, at, out = np.frombuffer(raw, np.int64, n), 8 * n, []
    for k in lengths.tolist():
        planes = np.frombuffer(raw, np.uint8, 8 * k, at).reshape(8, k)
        out.append(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64))
        at += 8 * k
    return out


def build(bag: Bag) -> bytes:
    """The count transducer of sorted windows: words, then for each depth arcs a state, labels, weights and targets."""
    numbers = [np.zeros(len(bag), np.int32)]   # of the distinct prefixes of each length, that is of the states
    head = np.zeros(len(bag), bool)
    head[:1] = True
    for c in bag.columns:
        head[1:] |= c[1:] != c[:-1]
        numbers.append(np.cumsum(head, dtype=np.int32) - 1)
    stored: list[np.ndarray] = []
    target_of = np.zeros(len(bag), np.int64)   # of the states one level deeper
    for depth in range(LENGTH - 1, -1, -1):
        above, below = numbers[depth], numbers[depth + 1]
        arcs = np.flatnonzero(np.diff(below, prepend=-1))
        weight = np.add.reduceat(bag.counts, arcs) if len(arcs) else bag.counts[:0]
        some = bag.columns[depth][arcs] > 0     # windows that end here have no arc
        arcs, weight = arcs[some], weight[some]
        label, target = bag.columns[depth][arcs].astype(np.int64), target_of[below[arcs]] if depth < LENGTH - 1 else np.zeros(len(arcs), np.int64)
        states = int(above[-1]) + 1 if len(above) else 0
        out = np.bincount(above[arcs], minlength=states)
        starts = np.cumsum(out) - out
        single = np.flatnonzero(out == 1)
        single = single[weight[starts[single]] == 1]
        arc = starts[single]
        key = label[arc] * (int(target.max(initial=0)) + 1) + target[arc]
        _, first, same = np.unique(key, return_index=True, return_inverse=True)
        # the first of equal states stands for all
        stands = np.arange(states)
        stands[single] = single[first][same]
        kept = stands == np.arange(states)
        target_of = (np.cumsum(kept) - 1)[stands]
        keep_arc = np.repeat(kept, out)
        stored = [out[kept], label[keep_arc], weight[keep_arc], target[keep_arc], *stored]
    return zstandard.compress(b"\n".join(bag.words), 1) + b"\x00ARCS" + _packed(stored)


def expand(data: bytes) -> Bag:
    """The windows of a transducer: every path, with the weight that goes no further."""
    words, _, arrays = data.partition(b"\x00ARCS")
    text = zstandard.decompress(words)
    levels = _unpacked(arrays, 4 * LENGTH)
    found: list[list[np.ndarray]] = [[] for _ in range(LENGTH)]
    counts = []
    paths: list[np.ndarray] = []
    weight, state = None, np.zeros(1 if len(levels[0]) else 0, np.int64)
    for depth in range(LENGTH):
        out, label, arc_weight, target = levels[4 * depth:4 * depth + 4]
        starts = np.cumsum(out) - out
        total = np.zeros(len(out), np.int64)
        np.add.at(total, np.repeat(np.arange(len(out)), out), arc_weight)
        if weight is not None:
            rest = weight - total[state]
            ends = np.flatnonzero(rest > 0)
            for k in range(LENGTH):
                found[k].append(paths[k][ends] if k < depth else np.zeros(len(ends), np.int64))
            counts.append(rest[ends])
        n = out[state]
        arc = np.repeat(starts[state] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        paths = [*(np.repeat(p, n) for p in paths), label[arc]]
        weight, state = arc_weight[arc], target[arc]
    for k in range(LENGTH):
        found[k].append(paths[k])
    counts.append(weight if weight is not None else np.zeros(0, np.int64))
    names = text.split(b"\n") if text else []
    return Bag(names, *_sorted_sums([np.concatenate(c) for c in found], np.concatenate(counts), len(names) + 1))


# ---- shards, ranges and union ---------------------------------------------------------------

# part -1 has the number of words instead of a transducer
_RANGES = "lang string, part long, words long, automaton binary"
_RANGES_SCHEMA = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("words", pa.int64()), ("automaton", pa.binary())])


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of a text that end with a piece, about a megabyte each."""
    data, start = data.translate(_FOLD), 0
    while start < len(data):
        end = data.find(b"\n", start + _CHUNK) + 1 or len(data)
        yield data[start:end]
        start = end


def _shard_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Bag]]:
    """(language, words, windows) of about ``SHARD_WORDS`` words each."""
    streams: dict[str, tuple[_Codes, list[np.ndarray], list[int]]] = {}

    def flush(lang: str) -> tuple[str, int, Bag]:
        codes, parts, held = streams.pop(lang)
        return lang, held[0], Bag.of_stream(list(codes)[1:], np.concatenate(parts))  # the first code is the piece end

    for b in batches:
        texts = b.column(1).cast(pa.large_string()).cast(pa.large_binary())
        for lang, text in zip(b.column(0).to_pylist(), texts):
            for data in _pieces(text.as_py() or b""):
                if lang not in streams:
                    codes = _Codes()
                    codes[b"\n"]
                    streams[lang] = codes, [], [0]
                codes, parts, held = streams[lang]
                tokens = data.replace(b"\n", b" \n ").split(b" ")
                stream = np.fromiter(map(codes.__getitem__, filter(None, tokens)), np.int32)
                parts.append(np.append(stream, np.int32(0)))
                held[0] += int(np.count_nonzero(stream))
                if held[0] >= SHARD_WORDS:
                    yield flush(lang)
    for lang in list(streams):
        yield flush(lang)


def _dealt(splitters: dict[str, list[list[bytes]]]):
    """A transducer for each shard and prefix range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, bag in _shard_bags(batches):
            yield pa.RecordBatch.from_pylist([{"lang": lang, "part": -1, "words": words}], _RANGES_SCHEMA)
            at = [0, *(bag.place(s) for s in splitters.get(lang, [])), len(bag)]
            for k, (s, e) in enumerate(zip(at, at[1:])):
                if s < e:
                    yield pa.RecordBatch.from_pylist([{"lang": lang, "part": k, "words": 0, "automaton": build(bag.part(s, e))}], _RANGES_SCHEMA)

    return run


def _drawn(step: int):
    """Every so many windows, in order, of the sampled shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, bag in _shard_bags(batches):
            rows = range(step // 2, len(bag), step)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows)), pa.array([bag.text(k).decode() for k in rows], pa.string())], names=["lang", "window"]
            )

    return run


_COUNTED = ["lang", "phrase", "length", "weight"]


def _united(splitters: dict[str, list[list[bytes]]], least: int):
    """(lang, phrase, length, weight) of each range: frequent phrases, and those at its ends, whatever their weight; length 0 counts words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bags, held = None, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            bag, (lang, part) = Bag.union(bags), now
            cuts = splitters.get(lang, [])
            ends = {b" ".join(s[:k]) for s in cuts[max(0, part - 1):part + 1] for k in range(1, LENGTH + 1)}
            # a phrase at an end runs into the neighbouring range, so it is among the first or last of its length
            for length, first, weight in bag.prefixes():
                keep = weight >= least
                if ends and len(first):
                    keep[[0, -1]] |= [bag.text(int(first[k]), length) in ends for k in (0, -1)]
                rows = first[keep]
                if len(rows):
                    phrases = [bag.text(int(k), length).decode() for k in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows)), pa.array(phrases), pa.array(np.full(len(rows), length, np.int64)), pa.array(weight[keep])],
                        names=_COUNTED,
                    )

        for b in batches:
            for r in range(b.num_rows):
                at = b.column(0)[r].as_py(), b.column(1)[r].as_py()
                if bags and at != now:
                    yield from close()
                    bags, held = [], 0
                now = at
                if at[1] < 0:
                    yield pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([""]), pa.array([0]), b.column(2).slice(r, 1)], names=_COUNTED)
                    continue
                bags.append(expand(b.column(3)[r].as_py()))
                held += len(bags[-1])
                if held > MERGE_WINDOWS and len(bags) > 1:
                    bags = [Bag.union(bags)]
                    held = len(bags[0]) // 2
        if bags:
            yield from close()

    return run


def _splitters(rows: DataFrame) -> dict[str, list[list[bytes]]]:
    """Windows that cut every language into ranges of about equal numbers of windows, from a bounded sample of documents."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    every = max(1, size // SAMPLE_BYTES)
    step = max(1, min(size, SAMPLE_BYTES) // 5 // SAMPLES)
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    drawn = sample.mapInArrow(_drawn(step), "lang string, window string").collect()  # about SAMPLES windows
    marks: dict[str, list[list[bytes]]] = {}
    for r in drawn:
        marks.setdefault(r["lang"], []).append(r["window"].encode().split(b" "))
    out = {}
    for lang, own in marks.items():
        own.sort()
        parts = min(len(own), -(-len(own) * step * every // RANGE_WINDOWS))
        cuts = sorted({tuple(own[len(own) * k // parts]) for k in range(1, parts)})
        out[lang] = [list(c) for c in cuts]
    return out


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, length, f) of phrases with a frequency of at least ``least``, (lang, n) words)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    splitters = _splitters(rows)
    ranges = sum(len(c) + 1 for c in splitters.values())
    parts = max(ranges, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.mapInArrow(_dealt(splitters), _RANGES).repartition(parts, "lang", "part").sortWithinPartitions("lang", "part")
    united = ordered.mapInArrow(_united(splitters, least), "lang string, phrase string, length long, weight long")
    counts = united.groupBy("lang", "phrase", "length").agg(F.sum("weight").alias("f")).where((F.col("f") >= least) | (F.col("length") == 0))
    stored = materialize(counts, "phrase-counts")
    return stored.where("length > 0"), stored.where("length = 0").select("lang", F.col("f").alias("n"))


def _words(start: int | Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, length), " ")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = MIN_COUNT, best: int = BEST, absorbed: int = ABSORBED
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of every language."""
    counts, words = phrase_counts(docs, lang_col, text_col, least)
    longer = counts.where("length > 2").select(
        "lang", "f", F.explode(F.array(_words(1, F.col("length").cast("int") - 1), _words(2, F.col("length").cast("int") - 1))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("f").alias("longest"))
    candidates = counts.where("length > 1").join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (F.lit(100) * F.col("longest") < F.lit(absorbed) * F.col("f"))
    )
    cuts = candidates.select("lang", "phrase", "length", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("length").cast("int") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _words(1, F.col("k")).alias("head"), _words(F.col("k") + 1, F.col("length").cast("int") - F.col("k")).alias("tail"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(words, "lang").withColumn(
        "score", F.expr("CAST((CAST(1000 AS DECIMAL(38, 0)) * a * n) div (CAST(l AS DECIMAL(38, 0)) * r) AS BIGINT)")
    )
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = lowest.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
