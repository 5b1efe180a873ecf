"""Exact deduplication by a content sort.

Normalised texts are range-partitioned at sampled splitters and sorted outside
memory, so that equal texts are neighbours; one pass over each sorted partition
compares every text in full with the one before it. The range key ends in the
identifier, so a text with very many copies spreads over several partitions. The
groups at partition edges are compared in full with the neighbouring partition's
and counted together.

The order is (first bytes, hash, whole text, identifier): the splitters that the
driver holds are short whatever the length of the texts, and texts that share a
long beginning are told apart by their hash before whole texts are compared.

Results by case: a null text counts as empty, and empty texts equal each other. A
null identifier only stays when its group has no other. Of rows that share text
and identifier exactly one stays. No rows give no rows. Other columns are not read
by ``content_groups`` and are returned as they are by ``drop_copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from riskloom.llm.common import numbered_names, tidy
from riskloom.session import materialize

PREFIX_BYTES = 64

_GROUPS = "id long, keep_id long, group_size long, leads boolean, text_sha256 string, part int, grp long, edge int, edge_text binary"


def _normalised_binary(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased bytes; null as empty."""
    return pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")).cast(pa.large_binary()).cast(pa.binary())


def _normalise(position: int):
    """Add the normalised bytes (A-Z lower-cased, null as empty) of the text at ``position`` as a last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, _normalised_binary(b.column(position))], names=[*b.schema.names, "_cs_key"])

    return run


def _sorted_by_content(rows: DataFrame, text_col: str, id_col: str, largest: bool, keep_key: bool) -> DataFrame:
    """Rows range-partitioned and sorted by content, so that the row that stays leads its copies.

    With ``keep_key`` the normalised bytes stay as ``_cs_key`` in the text's stead;
    without, the rows keep their columns, and the bytes are made again after the
    exchange rather than moved beside the text.
    """
    position = rows.columns.index(text_col)
    keyed = rows.mapInArrow(_normalise(position), StructType([*rows.schema.fields, StructField("_cs_key", BinaryType())]))
    keyed = keyed.withColumns({"_cs_head": F.substring("_cs_key", 1, PREFIX_BYTES), "_cs_hash": F.xxhash64("_cs_key")}).drop(text_col if keep_key else "_cs_key")
    identifier = F.col(id_col).desc_nulls_last() if largest else F.col(id_col).asc_nulls_last()
    ranged = keyed.repartitionByRange("_cs_head", "_cs_hash", identifier)
    if not keep_key:
        upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        ranged = ranged.withColumn("_cs_key", F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), upper, upper.lower()).cast("binary"))
    ordered = ranged.sortWithinPartitions("_cs_head", "_cs_hash", "_cs_key", identifier).drop("_cs_head", "_cs_hash")
    return ordered if keep_key else ordered.drop("_cs_key")


def _changes(keys: pa.Array, before: bytes | None) -> np.ndarray:
    """True where a text differs from the text before it."""
    new = np.ones(len(keys), bool)
    if len(keys) > 1:
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    if len(keys):
        new[0] = before is None or keys[0].as_py() != before
    return new


def _group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    schema = pa.schema([("id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("leads", pa.bool_()), ("text_sha256", pa.string()), ("part", pa.int32()), ("grp", pa.int64()), ("edge", pa.int32()), ("edge_text", pa.binary())])
    ids: list[pa.Array] = []  # identifiers of the group that is still open: 8 bytes a copy
    text: bytes | None = None
    grp = -1

    def closed(parts: list[pa.Array], starts: np.ndarray, shas: list[str], first: int, edges: dict[int, tuple[int, bytes]]) -> pa.RecordBatch:
        """Rows of groups that are whole; ``edges`` has the edge mark and text by local group."""
        flat = pa.concat_arrays(parts)
        sizes = np.diff(np.append(starts, len(flat)))
        of = np.repeat(np.arange(len(starts)), sizes)
        leads = np.zeros(len(flat), bool)
        leads[starts] = True
        marks, texts = np.zeros(len(starts), np.int32), [None] * len(flat)
        for g, (mark, value) in edges.items():
            marks[g], texts[starts[g]] = mark, value
        return pa.RecordBatch.from_arrays(
            [flat, flat.take(pa.array(starts[of])), pa.array(sizes[of]), pa.array(leads), pa.array(shas, pa.string()).take(pa.array(of)), pa.array(np.full(len(flat), part, np.int32)), pa.array(first + of), pa.array(marks[of]), pa.array(texts, pa.binary())],
            schema=schema,
        )

    for b in batches:
        if not b.num_rows:
            continue
        b_ids, keys = b.column(0).cast(pa.int64()), b.column(1)
        new = _changes(keys, text)
        starts = np.flatnonzero(new)
        if not len(starts):
            ids.append(b_ids)
            continue
        if grp >= 0:
            yield closed([*ids, b_ids.slice(0, int(starts[0]))], np.array([0]), [hashlib.sha256(text).hexdigest()], grp, {0: (1, text)} if grp == 0 else {})
        last = int(starts[-1])
        if len(starts) > 1:
            shas = [hashlib.sha256(keys[int(s)].as_buffer()).hexdigest() for s in starts[:-1]]
            lead = {0: (1, keys[0].as_py())} if grp < 0 else {}
            base = int(starts[0])
            yield closed([b_ids.slice(base, last - base)], starts[:-1] - base, shas, grp + 1, lead)
        grp += len(starts)
        ids, text = [b_ids.slice(last)], keys[last].as_py()
    if grp >= 0:
        yield closed(ids, np.array([0]), [hashlib.sha256(text).hexdigest()], grp, {0: (3 if grp == 0 else 2, text)})


def _edge_chains(edges: DataFrame) -> DataFrame:
    """(part, grp, chain_keep, chain_size, heads): totals of the groups that meet at partition edges.

    ``edges`` has at most two rows a partition, whatever the number of documents;
    their texts are compared in full with the neighbouring partition's.
    """
    order = Window.orderBy("part", "grp")
    follows = F.lag("edge_text").over(order) == F.col("edge_text")
    linked = edges.select("part", "grp", "keep_id", "group_size", F.when(follows, 0).otherwise(1).alias("starts"))
    chained = linked.withColumn("chain", F.sum("starts").over(order))
    whole = Window.partitionBy("chain").orderBy("part", "grp").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return chained.select(
        "part", "grp", F.first("keep_id").over(whole).alias("chain_keep"), F.sum("group_size").over(whole).alias("chain_size"), (F.col("starts") == 1).alias("heads")
    )


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    ``keep`` says which identifier of equal texts stays: ``smallest`` or ``largest``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = _sorted_by_content(rows, "text", "id", keep == "largest", keep_key=True).select("id", "_cs_key")
    groups = materialize(ordered.mapInArrow(_group_rows, _GROUPS), "content-groups")
    chains = _edge_chains(groups.where("edge > 0 AND leads"))
    joined = groups.join(chains, ["part", "grp"], "left")
    return joined.select(
        "id",
        F.when(F.col("chain_size").isNull(), F.col("keep_id")).otherwise(F.col("chain_keep")).alias("keep_id"),
        F.coalesce("chain_size", "group_size").alias("group_size"),
        (F.col("leads") & F.coalesce("heads", F.lit(True))).alias("kept"),
        "text_sha256",
    )


def _leaders(text_position: int):
    """Rows that differ from the row before them, with the partition, a mark on its first row, and its last text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        text, first, template = None, True, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = _normalised_binary(b.column(text_position))
            new = _changes(keys, text)
            out = b.filter(pa.array(new))
            n = out.num_rows
            edge = np.zeros(n, np.int32)
            if first:
                edge[0] = 1
            template = b.slice(0, 1)
            texts = pa.array([keys[0].as_py() if first and i == 0 else None for i in range(n)], pa.binary())
            first, text = False, keys[b.num_rows - 1].as_py()
            if n:
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.full(n, part, np.int32)), pa.array(edge), texts], names=[*out.schema.names, "_cs_part", "_cs_edge", "_cs_text"])
        if template is not None:  # a row of its own for the last text, dropped once compared
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, c.type) for c in template.columns), pa.array([part], pa.int32()), pa.array([2], pa.int32()), pa.array([text], pa.binary())], names=[*template.schema.names, "_cs_part", "_cs_edge", "_cs_text"])

    return run


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """Rows of ``docs`` with all their columns, one of each group of equal texts."""
    names = docs.columns
    docs, (text_col, id_col) = numbered_names(docs, text_col, id_col)
    ordered = _sorted_by_content(docs, text_col, id_col, keep == "largest", keep_key=False)
    schema = StructType([
        *(StructField(f.name, f.dataType, True) for f in docs.schema.fields),
        StructField("_cs_part", IntegerType()), StructField("_cs_edge", IntegerType()), StructField("_cs_text", BinaryType()),
    ])
    leaders = materialize(ordered.mapInArrow(tidy(_leaders(docs.columns.index(text_col))), schema), "content-leaders")
    edges = leaders.where("_cs_edge > 0").select("_cs_part", "_cs_edge", "_cs_text")
    order = Window.orderBy("_cs_part", "_cs_edge")
    again = (
        edges.withColumn("_cs_same", F.lag("_cs_text").over(order) == F.col("_cs_text"))
        .where("_cs_edge = 1 AND _cs_same").select("_cs_part", "_cs_edge")
    )
    return leaders.where("_cs_edge < 2").join(again, ["_cs_part", "_cs_edge"], "left_anti").select(*docs.columns).toDF(*names)
