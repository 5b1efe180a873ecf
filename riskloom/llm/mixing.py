"""Mixing sources to target weights.

Documents get a hash-random key, are sorted by it within ranges of the key (which
split every source evenly, as the key is uniform), and distributed prefix sums of
their sizes say where a source's budget ends. A source whose budget is more than it
holds is repeated in whole epochs first. Everything is a function of identifiers,
sources and texts, so reruns agree.

Results by case: a null text has size 0 and takes no words (``drawn`` returns such a row
if its key is ahead of its source's cut); a null source is a source
of its own, ordered last; sources of size 0 get target 0; rows that share an
identifier share a key and are ordered by text hash; no rows give no rows; columns
other than the three named ones are not read by ``mixed`` and kept by ``drawn``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import numbered_names, word_count
from riskloom.operators.ranks import numbered
from riskloom.session import materialize

# Weights of the sources in order, repeating; words of the mix as a
# share of all words; most copies of a document.
WEIGHTS = (3, 1, 2)
MIX_PERCENT = 150
MOST_COPIES = 2

ROWS_PER_RANGE = 5_000


def _key(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def _share(key: Column) -> Column:
    """The key's place in [0, 1), from its first 12 hex digits."""
    return F.conv(F.substring(key, 1, 12), 16, 10).cast("double") / float(16**12)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = MIX_PERCENT, copies: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, documents, target) from one row per source.

    A source's target is its weight's share, at most ``copies`` times its size; what
    it leaves is shared by weight among the others until no target is above. Each
    round is an aggregate over the source table that gives the driver four numbers.
    """
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "_mx_n")
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.col("_mx_n") - 1) % len(weights) + 1).cast("int"))
    table = materialize(ranked.withColumn("weight", w).withColumn("most", (F.col("source_size") * copies).cast("double")), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full = total * percent / 100.0, 0.0, -1
    while total:
        capped = F.col("most") <= F.lit(level) * F.col("weight")
        s = table.agg(
            F.count_if(capped).alias("n"), F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("given"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if s["n"] == full or not s["open"]:
            break
        full, level = s["n"], (budget - s["given"]) / s["open"]
    return table.select("source", "source_size", "documents", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"),
        _key(id_col, seed).alias("mix_key"), F.xxhash64(text).alias("text_hash"),
    )


def _prefix_sums(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """Narrow rows with their source's target and ``before``: the words ahead of a row in its source's order."""
    rows = materialize(_sized(docs, id_col, text_col, source_col, seed), "mix-rows")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    goals = materialize(targets(per_source), "mix-targets").withColumnRenamed("source", "_mx_source")
    ranges = F.ceil(F.col("documents") / ROWS_PER_RANGE)
    placed = rows.join(goals, F.col("source").eqNullSafe(F.col("_mx_source")), "left").drop("_mx_source").withColumn(
        "range", F.floor(_share(F.col("mix_key")) * ranges).cast("long")
    )
    within = Window.partitionBy("source", "range").orderBy("mix_key", F.col("id").asc_nulls_last(), "size", "text_hash")
    placed = placed.withColumn("_mx_in", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    sums = rows.join(goals, F.col("source").eqNullSafe(F.col("_mx_source")), "left").groupBy(
        F.col("source").alias("_mx_s"), F.floor(_share(F.col("mix_key")) * ranges).cast("long").alias("_mx_r")
    ).agg(F.sum("size").alias("_mx_sum"))
    ahead = sums.withColumn("_mx_ahead", F.sum("_mx_sum").over(Window.partitionBy("_mx_s").orderBy("_mx_r")) - F.col("_mx_sum")).drop("_mx_sum")
    return placed.join(ahead, F.col("source").eqNullSafe(F.col("_mx_s")) & (F.col("range") == F.col("_mx_r")), "left").withColumn(
        "before", F.col("_mx_ahead") + F.col("_mx_in")
    ).drop("_mx_s", "_mx_r", "_mx_ahead", "_mx_in")


def _epochs() -> Column:
    return F.when(F.col("source_size") > 0, F.floor(F.round(F.col("target")) / F.col("source_size"))).otherwise(0).cast("long")


def _last_epoch() -> Column:
    """Words of the last, partial epoch of a source."""
    return F.round(F.col("target")).cast("long") - _epochs() * F.col("source_size")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, taken.

    The words taken from a source add up to its target, rounded; the document at the
    cut gives the words that are still wanted.
    """
    part = F.least(F.greatest(_last_epoch() - F.col("before"), F.lit(0).cast("long")), F.col("size"))
    return _prefix_sums(docs, id_col, text_col, source_col, seed).select(
        "id", "source", "size", "source_size", "target", (_epochs() * F.col("size") + part).alias("taken")
    )


def drawn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The mix as documents: every row of ``docs`` as often as the mix takes it, with its columns as they were.

    Documents stay whole: the one at a cut is taken if at least half of it is wanted.
    Because the order is that of the key, one cut per source says it all, so texts
    are not moved; rows that share an identifier are taken alike.
    """
    names = docs.columns
    docs, (id_col, text_col, source_col) = numbered_names(docs, id_col, text_col, source_col)
    rows = _prefix_sums(docs, id_col, text_col, source_col, seed)
    wanted = (F.col("size") > 0) & (2 * (_last_epoch() - F.col("before")) >= F.col("size"))
    cuts = materialize(
        rows.groupBy(F.col("source").alias("_mx_source")).agg(F.first(_epochs()).alias("_mx_epochs"), F.max(F.when(wanted, F.col("mix_key"))).alias("_mx_cut")),
        "mix-cuts",
    )
    more = F.coalesce(_key(id_col, seed) <= F.col("_mx_cut"), F.lit(False)).cast("int")
    copies = F.coalesce(F.col("_mx_epochs"), F.lit(0)).cast("int") + more
    joined = docs.join(cuts, F.col(source_col).cast("string").eqNullSafe(F.col("_mx_source")), "left").withColumn("_mx_copies", copies)
    return joined.where("_mx_copies > 0").withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), F.col("_mx_copies")))).select(*docs.columns).toDF(*names)
