import random

import numpy as np
import pytest
import xxhash

from riskloom.llm import simhash_grid as sg
from riskloom.llm.components import components
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA

WHITE = " \t\n\x0b\x0c\r"


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = []
    word = ""
    for c in text + " ":
        if c in WHITE:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items):
    """{position: smallest id reachable} over (id, fingerprint) pairs, all pairs compared."""
    fps = sorted({f for _, f in items})
    arr = np.array(fps, np.uint64)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 4):
            a, b = find(f), find(fps[i + 1 + j])
            root[max(a, b)] = min(a, b)
    least = {}
    for d, f in items:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [least.get(find(f)) for _, f in items]


def as_unsigned(fp):
    return fp & (2**64 - 1)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want_fp = {r.doc_id: f"{plain_fingerprint(r.text):016x}" for r in docs}
    comps = plain_components([(r.doc_id, int(want_fp[r.doc_id], 16)) for r in docs])
    want = {r.doc_id: (want_fp[r.doc_id], c) for r, c in zip(docs, comps)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in LLM_QUERIES["op4_simhash_grid"](spark, DATA).collect()}
    assert got == want


@pytest.mark.parametrize("limits", [(4096, 256), (8, 3)])
def test_links_of_clusters_and_chains(spark, monkeypatch, limits):
    monkeypatch.setattr(sg, "CELL_ROWS", limits[0])
    monkeypatch.setattr(sg, "SCAN_RUN", limits[1])
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(400)]
    for centre in prints[:6]:  # clusters and chains of near fingerprints
        at = centre
        for _ in range(60):
            prints.append(at ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
            at = prints[-1] if rng.random() < 0.3 else centre
    items = [(i, p) for i, p in enumerate(dict.fromkeys(prints))]
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in items], "fp long, rep long")
    got = {r.fp: r.component_id for r in sg._component_of_print(rows, 4, 7).collect()}
    want = plain_components(items)
    assert [got[p - (1 << 64) if p >> 63 else p] for _, p in items] == want


def test_one_huge_cell_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sg, "CELL_ROWS", 16)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        rng = random.Random(2)
        centre = rng.getrandbits(64)
        prints = {centre ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 6))) for _ in range(900)}
        items = list(enumerate(sorted(prints)))
        rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in items], "fp long, rep long")
        got = {as_unsigned(r.fp): r.component_id for r in sg._component_of_print(rows, 4, 7).collect()}
        assert [got[p] for _, p in items] == plain_components(items)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_fingerprint_cases():
    long = ("word%d " * 50_000) % tuple(range(50_000))
    for text in ["", None, "  \n", "one", "A b C", "a b c d", "É é A B\x1cC d e f", "x " * 70_000, long]:
        assert sg.fingerprint(text) == plain_fingerprint(text)


def test_long_text_is_read_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = sg.fingerprint(text)
    monkeypatch.setattr(sg, "_CHUNK", 64)
    assert sg.fingerprint(text) == whole


def test_nulls_ties_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame(
        [(3, None, "x", 1), (1, "", "y", 2), (None, " ", "z", 3), (7, "a b c d e", "u", 4), (7, "a b c d e", "u", 4), (9, "q r s t u v", None, 5)],
        "doc_id long, text string, fp string, id int",
    )
    got = sorted(((r.id, r.component_id) for r in sg.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (None, 1), (7, 7), (7, 7), (9, 9)], key=str)
    kept = sg.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7, 7, 9]
    none = docs.where("false")
    assert sg.near_duplicates(none).count() == 0 and sg.drop_near_copies(none).count() == 0


def test_components_without_identifiers_stay_apart(spark):
    one, two, three = ("the first of these reports tells of a river", "seven other people bought bread at noon", "nothing here is like any other line at all")
    docs = spark.createDataFrame([(None, one), (None, two), (None, two), (None, three), (4, three), (5, one + " x y z " + two)], "doc_id long, text string")
    kept = sorted((r.text, str(r.doc_id)) for r in sg.drop_near_copies(docs).collect())
    assert kept == sorted([(one, "None"), (two, "None"), (two, "None"), (three, "4"), (one + " x y z " + two, "5")])
    assert len({r.component for r in sg.near_duplicates(docs).collect()}) == 4


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
