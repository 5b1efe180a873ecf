import hashlib
import random

import pytest

from riskloom.llm import content_sort as cs
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA


def norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, largest=True):
    """{(id, text): (keep, size, sha)} by a dictionary of whole texts."""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = (max if largest else min)(ids) if ids else None
        out.append((i, keep, len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rows = LLM_QUERIES["op1_content_sort_dedup"](spark, DATA).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == plain(docs)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)


@pytest.mark.parametrize("largest", [True, False])
def test_groups_over_many_partitions(spark, largest):
    rng = random.Random(3)
    texts = ["", "A", "a", "É a", "é a", "x" * 200 + "A", "x" * 200 + "b"] + [f"t{i}" for i in range(20)]
    rows = [(i, "The hot one" if rng.random() < 0.4 else rng.choice(texts)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        keep = "largest" if largest else "smallest"
        got = cs.content_groups(frame, keep=keep).collect()
        assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == plain(rows, largest)
        assert sorted(r.id for r in got if r.kept) == sorted({r.keep_id for r in got})
        left = cs.drop_copies(frame, keep=keep).collect()
        assert sorted(r.doc_id for r in left) == sorted({r.keep_id for r in got})
        assert all(dict(rows)[r.doc_id] == r.text for r in left)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_ties_empty_tables_long_texts_and_extra_columns(spark):
    long = "Word " * 100_000
    rows = [(1, None, 1, "a"), (2, "", 2, "b"), (None, "", 3, "c"), (4, "Same", 4, "d"), (4, "same", 5, "e"), (4, "same", 5, "e"), (None, "alone", 6, "f"), (8, long, 7, "g"), (9, long.upper(), 8, "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id int, keep_id string")
    got = cs.content_groups(frame, keep="largest").collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == plain([r[:2] for r in rows])
    assert sum(r.kept for r in got) == 4
    left = cs.drop_copies(frame)
    assert left.columns == frame.columns
    assert sorted((str(r.doc_id), norm(r.text)[:9]) for r in left.collect()) == sorted([("1", ""), ("4", "same"), ("None", "alone"), ("8", "word word")])
    none = frame.where("false")
    assert cs.content_groups(none).count() == 0 and cs.drop_copies(none).count() == 0
