import hashlib
import random
import re

import duckdb
import pytest

from riskloom.llm import mixing as mx
from riskloom.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.conftest import DATA


def size_of(text):
    return len([w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w])


def plain_targets(sizes):
    """Targets by resharing the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def plain_mix(rows):
    """{id: (size, source size, target, taken)} for rows with unique identifiers."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    target = plain_targets(sizes)
    out = {}
    for s in sizes:
        own = sorted((hashlib.md5(f"mix:{i}".encode()).hexdigest(), i, size_of(t)) for i, t, x in rows if x == s)
        goal = int(target[s] + 0.5)
        epochs = goal // sizes[s] if sizes[s] else 0
        rest = goal - epochs * sizes[s]
        for _, i, n in own:
            part = min(max(rest, 0), n)
            rest -= n
            out[i] = (n, sizes[s], round(target[s], 4), epochs * n + part)
    return out


def test_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cursor = con.execute(LLM_ORACLES["op6_source_mix"])
    names = [d[0] for d in cursor.description]
    rows = LLM_QUERIES["op6_source_mix"](spark, DATA).select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(cursor.fetchall())
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert {r.doc_id: (r.size, r.source_size, round(r.target, 4), r.taken) for r in rows} == plain_mix(docs)


@pytest.mark.parametrize("per_range", [5_000, 7])
def test_taken_words_meet_the_targets(spark, monkeypatch, per_range):
    monkeypatch.setattr(mx, "ROWS_PER_RANGE", per_range)
    rng = random.Random(4)
    names = ["hot", "é", "a", "B", None, "empty", "tiny"]
    rows = []
    for i in range(700):
        s = rng.choices(names, [20, 3, 3, 2, 2, 1, 1])[0]
        rows.append((i, None if s == "empty" else "w " * rng.randint(0, 40 if s != "tiny" else 2), s))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mx.mixed(frame).collect()
    assert {r.id: (r.size, r.source_size, round(r.target, 4), r.taken) for r in got} == plain_mix(rows)
    for s in names:
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == int(own[0].target + 0.5) if own else True
    assert all(r.taken <= 2 * r.size for r in got)
    again = {r.id: r.taken for r in mx.mixed(frame.repartition(5)).collect()}
    assert again == {r.id: r.taken for r in got}
    # whole documents: as often as the mix takes them, the one at a cut if at least half is wanted
    copies = {}
    for r in mx.drawn(frame).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for r in got:
        if r.size:
            assert copies.get(r.id, 0) == r.taken // r.size + (2 * (r.taken % r.size) >= r.size)


def test_nulls_ties_empty_tables_and_extra_columns(spark):
    rows = [(1, None, "s", 1), (2, "a b", None, 2), (2, "a b", None, 2), (None, "c " * 50_000, "s", 3), (5, "", "t", 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    got = mx.mixed(frame).collect()
    assert len(got) == 5 and sum(r.taken for r in got) == round(1.5 * 50_004)
    drawn = mx.drawn(frame)
    assert drawn.columns == frame.columns and {r.doc_id for r in drawn.collect()} <= {1, 2, None}
    none = frame.where("false")
    assert mx.mixed(none).count() == 0 and mx.drawn(none).count() == 0
    silent = frame.where("doc_id IN (1, 5)")
    assert [r.taken for r in mx.mixed(silent).collect()] == [0, 0] and mx.drawn(silent).count() == 0
