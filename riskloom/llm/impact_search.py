"""Ranked lexical search by sequential reads of impact-sorted lists (no random access).

Documents are indexed in segments of bounded size: a row of the index holds the
documents of one segment and, for each term, its documents and occurrences. A
search task puts each list of a segment in order of falling impact and reads all
lists of an item side by side, a stretch at a time. Every document met has a score
interval: the impacts read so far, and those plus the frontier impact of each list in
which it was not met yet. Reading goes on until no unmet document can enter the
result, every interval that reaches the result's last score has closed, and with it
membership, ties and scores are final. The last score of earlier segments of the task
is the bar for the next one, so most segments of a long task end after few reads.

Weights need the collection's counts (documents, terms, documents of a term), which are
summed over the index. Items are taken in blocks of bounded size; what is sent to every
task is one block of items with the weights of its terms.

Results by case: null and empty texts hold no term, count in no statistic and are never
found; an item without a term has no result; a null document identifier ranks after
others of its score; repeated rows are documents of their own, as are repeated items
(each item row has its own result rows); equal scores go by identifier; no documents or
no items give no rows; a long text is read a megabyte at a time, its postings are at
most one for each distinct term; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from riskloom.session import materialize

# Term separators are the ASCII characters that are neither letters nor digits.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytearray(bytes(range(256)).lower())
for _c in _SEPARATORS:
    _FOLD[_c] = 0x20
_FOLD = bytes(_FOLD)

RESULTS = 10                 # documents an item
SEGMENT_DOCS = 16384         # documents of a segment
SEGMENT_POSTINGS = 2_000_000  # postings of a segment; a single long document may add its own to that
ITEM_BLOCK_BYTES = 4_000_000  # text of the items that are searched in one pass
FIRST_READ = 64              # postings of each list read first; later stretches are four times longer
_CHUNK = 1 << 20

INDEX = (
    "n_docs long, n_terms long, ids array<long>, sizes array<long>, terms array<string>, "
    "lengths array<int>, docs binary, occurrences binary"
)


# ---- terms and index ------------------------------------------------------------------------


def term_chunks(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, about a megabyte of it at a time."""
    start = 0
    while start < len(data):
        end = start + _CHUNK
        part = data[start:end].translate(_FOLD)
        if end < len(data):
            cut = part.rfind(b" ", 1)
            while cut < 0 and end < len(data):  # one term longer than a chunk
                end += _CHUNK
                part = data[start:end].translate(_FOLD)
                cut = part.rfind(b" ", 1)
            if end < len(data):
                part, end = part[:cut], start + cut
        yield part.split()
        start = end


class _Codes(dict):
    """Consecutive codes, given on first sight."""

    def __missing__(self, term: bytes) -> int:
        self[term] = code = len(self)
        return code


class _Segment:
    def __init__(self, vocabulary: dict[bytes, int] | None):
        self.codes = _Codes() if vocabulary is None else vocabulary
        self.code_of = self.codes.__getitem__ if vocabulary is None else vocabulary.get
        self.n_docs = self.n_terms = self.postings = 0
        self.ids, self.sizes, self.lists, self.counts = [], [], [], []

    def add(self, doc_id: int | None, data: bytes) -> None:
        size, found = 0, Counter()
        for terms in term_chunks(data):
            size += len(terms)
            found.update(map(self.code_of, terms))
        found.pop(None, None)
        if not size:
            return
        self.n_docs, self.n_terms = self.n_docs + 1, self.n_terms + size
        if found:
            self.ids.append(doc_id), self.sizes.append(size)
            self.lists.append(np.fromiter(found.keys(), np.int64, len(found)))
            self.counts.append(np.fromiter(found.values(), np.uint32, len(found)))
            self.postings += len(found)

    def batch(self) -> pa.RecordBatch:
        codes = np.concatenate([*self.lists, np.zeros(0, np.int64)])
        counts = np.concatenate([*self.counts, np.zeros(0, np.uint32)])
        docs = np.repeat(np.arange(len(self.lists), dtype=np.uint32), [len(x) for x in self.lists])
        order = np.argsort(codes, kind="stable")
        used, lengths = np.unique(codes, return_counts=True)
        names = list(self.codes)
        row = {
            "n_docs": self.n_docs, "n_terms": self.n_terms, "ids": self.ids, "sizes": self.sizes, "terms": [names[c].decode() for c in used],
            "lengths": lengths.tolist(), "docs": docs[order].tobytes(), "occurrences": counts[order].tobytes(),
        }
        schema = pa.schema([
            ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
            ("terms", pa.list_(pa.string())), ("lengths", pa.list_(pa.int32())), ("docs", pa.binary()), ("occurrences", pa.binary()),
        ])
        return pa.RecordBatch.from_pylist([row], schema)


def build_index(docs: DataFrame, vocabulary: Iterable[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a segment (``INDEX``); with a vocabulary, postings of its terms only (counts cover all terms).

    The vocabulary goes to every task, so it must be of bounded size; ``search_documents``
    takes it from a block of items.
    """
    known = None if vocabulary is None else {t.encode(): k for k, t in enumerate(sorted(set(vocabulary)))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment(known)
        for b in batches:
            texts = b.column(1).cast(pa.large_string()).cast(pa.large_binary())
            for doc_id, text in zip(b.column(0).to_pylist(), texts):
                segment.add(doc_id, text.as_py() or b"")
                if segment.n_docs >= SEGMENT_DOCS or segment.postings >= SEGMENT_POSTINGS:
                    yield segment.batch()
                    segment = _Segment(known)
        if segment.n_docs:
            yield segment.batch()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, INDEX)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, terms): the distinct terms of every item row, which ``item`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.large_string()).cast(pa.large_binary())
            terms = [sorted({t.decode() for part in term_chunks(x.as_py() or b"") for t in part}) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(terms, pa.list_(pa.string()))], names=["item", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item long, item_id long, terms array<string>").where(F.size("terms") > 0)


# ---- search ---------------------------------------------------------------------------------


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, bar: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the best ``k`` with a score of at least ``bar``, and their exact scores.

    ``lists`` has (documents, impacts) of each term, impacts falling, no document twice.
    """
    lists = [(d, s) for d, s in lists if len(s) and s[0] > 0]
    low = np.zeros(n_docs, np.int64)
    if not lists:
        return np.zeros(0, np.int64), low[:0]
    alive = np.ones(n_docs, bool)   # documents whose interval still reaches the result
    start, step, closed = 0, FIRST_READ, False
    while True:
        end = start + step
        for d, s in lists:
            if closed:
                mine = alive[d[start:end]]
                low[d[start:end][mine]] += s[start:end][mine]
            else:
                low[d[start:end]] += s[start:end]
        frontier = [int(s[end - 1]) if end < len(s) else 0 for _, s in lists]
        unmet = sum(frontier)
        if n_docs >= k:
            bar = max(bar, int(np.partition(low, n_docs - k)[n_docs - k]))
        met = np.zeros(n_docs, np.int64)
        for (d, _), f in zip(lists, frontier):
            if f:
                met[d[:end]] += f
        high = low + (unmet - met)
        alive &= (high >= bar) & (high > 0)
        if unmet < bar:
            closed = True
            alive &= low > 0
        if not unmet or closed and (high[alive] == low[alive]).all():
            found = np.flatnonzero(alive & (low > 0))
            return found, low[found]
        start, step = end, step * 4


def _searched(items: list[tuple[int, list[tuple[str, int]]]], n: int, length: int, k: int):
    """Best ``k`` documents of every item among the segments of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, bool, int]]] = {item: [] for item, _ in items}
        for b in batches:
            col = {name: b.column(j) for j, name in enumerate(b.schema.names)}
            for r in range(b.num_rows):
                ids = col["ids"][r].as_py()
                sizes = np.array(col["sizes"][r].as_py(), np.int64)
                docs = np.frombuffer(col["docs"][r].as_py(), np.uint32).astype(np.int64)
                tf = np.frombuffer(col["occurrences"][r].as_py(), np.uint32).astype(np.int64)
                lengths = np.array(col["lengths"][r].as_py(), np.int64)
                norm = 10 + (90 * sizes * n) // length
                part = (1_000_000_000 * tf) // (1000 * tf + 8 * norm[docs])
                order = np.lexsort((docs, -part, np.repeat(np.arange(len(lengths)), lengths)))
                docs, part = docs[order], part[order]
                ends = np.cumsum(lengths)
                at = {t: slice(e - c, e) for t, c, e in zip(col["terms"][r].as_py(), lengths.tolist(), ends.tolist())}
                for item, weights in items:
                    lists = [(docs[at[t]], part[at[t]] * w) for t, w in weights if t in at]
                    held = best[item]
                    found, scores = nra(lists, len(ids), k, -held[-1][0] if len(held) == k else 0)
                    if len(found):
                        new = [(-s, ids[d] is None, ids[d] or 0) for d, s in zip(found.tolist(), scores.tolist())]
                        best[item] = sorted(held + new)[:k]
        rows = [(item, None if null else doc, -score) for item, held in best.items() for score, null, doc in held]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows)], names=["item", "doc_id", "score"]
            )

    return run


def search(index: DataFrame, items: list[Row], k: int = RESULTS) -> DataFrame:
    """(item_id, rank, doc_id, score) of a bounded block of items (rows of ``item_terms``) over a written index."""
    spark = index.sparkSession
    out = "item long, doc_id long, score long"
    n, length = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    names = spark.createDataFrame([(r["item"], r["item_id"]) for r in items], "item long, item_id long")
    wanted = sorted({t for r in items for t in r["terms"]})
    if n and wanted:
        lists = index.select(F.explode(F.arrays_zip("terms", "lengths")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.lengths").alias("docs"))
        df = lists.join(spark.createDataFrame([(t,) for t in wanted], "term string"), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("df"))
        weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double")))
        weights = {r["term"]: r["w"] for r in df.select("term", weight.alias("w")).collect()}  # at most the block's terms
        block = [(r["item"], [(t, weights[t]) for t in r["terms"] if weights.get(t)]) for r in items]
        found = index.mapInArrow(_searched(block, n, length, k), out)
    else:
        found = spark.createDataFrame([], out)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search_documents(
    docs: DataFrame, items: DataFrame, k: int = RESULTS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The best ``k`` documents of every item; one pass over the documents for each block of items."""
    asked = materialize(item_terms(items, item_col, item_text_col), "search-items")
    size = asked.agg(F.sum(F.length(F.array_join("terms", " ")))).first()[0] or 0
    blocks = max(1, math.ceil(size / ITEM_BLOCK_BYTES))
    result = None
    for k_block in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k_block).collect()  # bounded by the block size
        terms = {t for r in block for t in r["terms"]}
        index = materialize(build_index(docs, terms, id_col, text_col), "search-index")
        part = search(index, block, k)
        result = part if result is None else result.unionByName(part)
    return result
