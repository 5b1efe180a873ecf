"""Near-duplicate documents by SimHash fingerprints and a grid join on segment bit counts.

A fingerprint's 64 bits are cut into 2-bit segments and mapped to the number of set
bits of each. The Manhattan distance of two such count vectors never exceeds the
Hamming distance of the fingerprints, so it is a lower bound. The 32 counts are cut
into blocks; fingerprints within distance d differ in at most d blocks, so they
agree in all counts of at least (blocks - d) of them, and every choice of that many
blocks is one grid whose cells are the agreeing counts. Within a cell, pairs are
filtered by the Manhattan bound and then verified by Hamming distance.

Cells are spread by range over (cell, fingerprint), so a hot cell spans partitions;
cells that meet at a partition edge are finished afterwards in pairs of blocks of
bounded size. Inside a cell only the edges of a spanning forest are kept: a group of
k near copies gives at most k - 1 links a grid, never all pairs, and no two
fingerprints that are linked end up in different components.

Results by case: null or wordless texts have fingerprint 0 and link like any other;
rows with equal fingerprints are linked, so repeated rows share their component; a
null identifier is in its component but never names it; no rows give no rows; other
columns are not read by ``near_duplicates`` and kept by ``drop_near_copies``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import numbered_names, tidy
from riskloom.llm.components import components
from riskloom.session import materialize

# Words a shingle, hash seed, most differing bits of linked fingerprints.
SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4

SEGMENTS = 32          # of two bits each
BLOCKS = 7             # 35 grids at distance 4; more blocks make smaller cells and more grids
CELL_ROWS = 4096       # rows of a block when a cell is finished in pairs of blocks
SCAN_RUN = 256         # longest cell that is compared by shifting arrays

_LOW = 0x5555555555555555
_CHUNK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---- fingerprints ---------------------------------------------------------------------------


def _word_chunks(data: bytes) -> Iterator[list[bytes]]:
    """Words of a long text, about a megabyte of text at a time."""
    start = 0
    while start < len(data):
        end = start + _CHUNK
        if end < len(data):
            m = _SPACE.search(data, end)
            end = m.start() if m else len(data)
        yield data[start:end].split()
        start = end


def _hash_chunks(data: bytes) -> Iterator[np.ndarray]:
    before: list[bytes] = []
    some = False
    for words in _word_chunks(data):
        words = before + words
        if len(words) >= SHINGLE_WORDS:
            some = True
            shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE_WORDS))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        before = words[-(SHINGLE_WORDS - 1):]
    if not some and before:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(before), SEED)], np.uint64)


def fingerprint(text: str | bytes | None) -> int:
    """SimHash of a whole text: bit set if set in over half of its shingles' hashes."""
    data = (text.encode() if isinstance(text, str) else text or b"").lower()
    total, votes = 0, np.zeros(64, np.int64)
    for hashes in _hash_chunks(data):
        for at in range(0, len(hashes), 65536):
            block = hashes[at:at + 65536]
            votes += np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = (2 * votes > total).astype(np.uint8) if total else np.zeros(64, np.uint8)
    return int(np.packbits(bits).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(1).cast(pa.large_string()).cast(pa.large_binary())
        prints = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64)), b.column(2)], names=["id", "fp", "row_hash"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, row_hash): the fingerprint as a signed long, and a hash of the text that tells rows of one id apart."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("row_hash"))
    return rows.mapInArrow(tidy(_fingerprints), "id long, fp long, row_hash long")


# ---- grid join ------------------------------------------------------------------------------


def _counts_code(fp: np.ndarray) -> np.ndarray:
    """The bit count of every 2-bit segment in unary (0: 00, 1: 01, 2: 11): differing bits are the Manhattan distance."""
    high, low = (fp >> np.uint64(1)) & np.uint64(_LOW), fp & np.uint64(_LOW)
    return (high | low) | ((high & low) << np.uint64(1))


def _counts_code_column(fp: Column) -> Column:
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW)), fp.bitwiseAND(F.lit(_LOW))
    return high.bitwiseOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def _grid_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of the grids: every choice of (blocks - distance) blocks of segments."""
    ends = [round(k * SEGMENTS / blocks) * 2 for k in range(blocks + 1)]
    parts = [(1 << ends[k + 1]) - (1 << ends[k]) for k in range(blocks)]
    return [reduce(int.__or__, c) for c in combinations(parts, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cells(prints: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(cell, fp): every fingerprint in its cell of each grid.

    A cell's number is a hash of grid and counts; cells that share a number by chance
    only give candidates that the bound and the exact distance sort out.
    """
    code = _counts_code_column(F.col("fp"))
    grids = F.array(*(F.xxhash64(F.lit(k), code.bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(_grid_masks(distance, blocks))))
    return prints.select(F.explode(grids).alias("cell"), "fp")


def _forest(fp: np.ndarray, code: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of a long cell: a fingerprint leaves the search once it is reached."""
    edges: list[tuple[int, int]] = []
    left, queue = np.arange(len(fp)), []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        p = queue.pop()
        near = np.bitwise_count(code[left] ^ code[p]) <= distance
        near[near] = np.bitwise_count(fp[left[near]] ^ fp[p]) <= distance
        hit = left[near]
        if len(hit):
            edges.extend((p, int(h)) for h in hit)
            queue.extend(hit.tolist())
            left = left[~near]
    return edges


def _linked(cell: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (by position) of the components inside each run of equal cells."""
    n = len(cell)
    code = _counts_code(fp)
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if n else np.zeros(0, int)
    sizes = np.diff(np.append(starts, n))
    follow = np.repeat(starts + sizes, sizes) - np.arange(n) - 1  # later members of the run
    us, vs = [], []
    for s, k in zip(starts[sizes > SCAN_RUN], sizes[sizes > SCAN_RUN]):
        e = np.array(_forest(fp[s:s + k], code[s:s + k], distance), np.int64).reshape(-1, 2)
        us.append(e[:, 0] + s), vs.append(e[:, 1] + s)
        follow[s:s + k] = 0
    act = np.flatnonzero(follow >= 1)
    d = 1
    while len(act):
        near = np.bitwise_count(code[act] ^ code[act + d]) <= distance
        u = act[near]
        u = u[np.bitwise_count(fp[u] ^ fp[u + d]) <= distance]
        us.append(u), vs.append(u + d)
        d += 1
        act = act[follow[act] >= d]
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    root = np.arange(n)
    while len(u):
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, u, low), np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(n))
    return root[moved], moved


def _link_rows(distance: int):
    """Links inside sorted cells, and the first and last cell of the partition (kind 1), which may go on next door."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = None

        def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"])

        def links(c: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            u, v = _linked(c, f, distance)
            return out(0, f[u], f[v])

        for b in batches:
            if not b.num_rows:
                continue
            cell = np.append(cell, b.column(0).to_numpy(zero_copy_only=False))
            fp = np.append(fp, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            first = cell[0] if first is None else first
            if cell[0] != cell[-1]:
                cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1  # the last run may go on
                yield links(cell[:cut], fp[:cut])
                cell, fp = cell[cut:], fp[cut:]
        if first is not None:
            yield links(cell, fp)
            part = TaskContext.get().partitionId()
            ends = np.array([first] if first == cell[-1] else [first, cell[-1]], np.int64)
            yield out(1, ends, np.full(len(ends), part, np.int64))

    return run


def _by_cell(cells: DataFrame, distance: int) -> DataFrame:
    ordered = cells.repartitionByRange("cell", "fp").sortWithinPartitions("cell", "fp")
    return ordered.mapInArrow(tidy(_link_rows(distance)), "kind int, a long, b long")


def _across(cells: DataFrame, distance: int) -> DataFrame:
    """Links inside the given cells, whose rows lie in several partitions: blocks of bounded size meet in pairs."""
    blocks = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("n"))
    placed = cells.join(blocks, "cell").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")))
    paired = placed.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    keyed = paired.select(F.xxhash64("cell", F.least("i", "j"), F.greatest("i", "j")).alias("cell"), "fp")
    ordered = keyed.repartition("cell").sortWithinPartitions("cell", "fp")
    return ordered.mapInArrow(tidy(_link_rows(distance)), "kind int, a long, b long").where("kind = 0")


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): edges that connect all fingerprints within ``distance`` of each other, few per component.

    ``prints`` has distinct values in column fp.
    """
    if blocks <= distance:
        raise ValueError("there must be more blocks than differing bits")
    found = materialize(_by_cell(_cells(prints, distance, blocks), distance), "grid-links")
    edges = found.where("kind = 0").select("a", "b").distinct()
    # at most two cells a partition, so this table is bounded by the number of partitions
    split = materialize(found.where("kind = 1").groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("a").alias("cell")), "split-cells")
    rows = materialize(_cells(prints, distance, blocks).join(split, "cell", "left_semi"), "split-rows")
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if sizes > CELL_ROWS:
        # cells whose members are connected already need no more work
        known = materialize(components(edges), "known")
        roots = rows.join(known, F.col("fp") == F.col("node"), "left").select("cell", "fp", F.coalesce("root", "fp").alias("root"))
        open_cells = roots.groupBy("cell").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("cell")
        rows = rows.join(open_cells, "cell", "left_semi")
    return edges.unionByName(_across(rows, distance).select("a", "b")).distinct()


def _component_of_print(prints: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(fp, component, component_id) for the distinct fingerprints with their smallest identifier ``rep``.

    ``component`` is the component's smallest fingerprint, never null; ``component_id``
    is null where all its identifiers are.
    """
    known = components(links(prints.select("fp"), distance, blocks))
    named = materialize(known, "component-nodes").join(prints, F.col("node") == F.col("fp"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = named.join(least, "root").select("node", "root", "component_id")
    return prints.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("component"), F.when(F.col("node").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """(id, row_hash, fp, component, component_id), one row per row of ``docs``."""
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("rep")), "distinct-fingerprints")
    # written, so that both sides of the join are plain exchanges, whose hot fingerprints Spark can split
    components_of = materialize(_component_of_print(prints, distance, blocks), "component-of-fingerprint")
    return rows.join(components_of, "fp").select("id", "row_hash", "fp", "component", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Rows of ``docs`` with all columns, one of each component: the smallest identifier (then text hash).

    Rows that share identifier and text stay or go together.
    """
    names = docs.columns
    docs, (id_col, text_col) = numbered_names(docs, id_col, text_col)
    found = materialize(near_duplicates(docs, id_col, text_col, distance, blocks), "near-duplicates")
    stays = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("x"), "id", "row_hash")).alias("w"))
    gone = found.join(stays, "component").where(
        ~(F.col("id").eqNullSafe(F.col("w.id")) & (F.col("row_hash") == F.col("w.row_hash")))
    ).select(F.col("id").alias("_sg_id"), F.col("row_hash").alias("_sg_hash")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_sg_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_sg_hash"))
    return docs.join(gone, same, "left_anti").toDF(*names)
