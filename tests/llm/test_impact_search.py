import math
import random
import re

import numpy as np

from riskloom.llm import impact_search as ims
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, item bigint, score long, terms string"


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=10):
    """[(item position, rank, doc_id, score)] by scoring every document for every item."""
    rows = [(d, plain_terms(t)) for d, t in docs]
    rows = [(d, t) for d, t in rows if t]
    n, length = len(rows), sum(len(t) for _, t in rows)
    out = []
    for i, text in items:
        scores = [0] * len(rows)
        for term in set(plain_terms(text)):
            df = sum(term in t for _, t in rows)
            if not df:
                continue
            w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
            for j, (_, t) in enumerate(rows):
                tf = t.count(term)
                if tf:
                    scores[j] += w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + 90 * len(t) * n // length)))
        best = sorted((-s, d is None, d or 0) for s, (d, _) in zip(scores, rows) if s > 0)[:k]
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(best)]
    return out


def as_rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    assert as_rows(LLM_QUERIES["op11_nra_search"](spark, DATA)) == sorted(plain_search(docs, items), key=str)


def test_edge_cases(spark):
    long_text = "alpha " * 300_000 + "z" * 2_500_000 + " beta"
    docs = [(1, "Alpha beta"), (1, "Alpha beta"), (2, "alpha beta"), (3, None), (4, ""), (5, "-- !"), (None, "beta gamma"), (7, "été Été ÉTÉ"), (8, long_text),
            (9, "GAMMA\x00gamma_gamma"), (10, "beta gamma")]
    items = [(1, "alpha BETA beta"), (2, "gamma, gamma"), (3, None), (4, "…"), (5, "absent"), (None, "été"), (1, "beta"), (6, "z" * 2_500_000)]
    frame = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], SCHEMA)
    asked = spark.createDataFrame([(i, t, 3, 4, "y") for i, t in items], "item_id long, text string, item bigint, score long, rank string")
    got = as_rows(ims.search_documents(frame, asked))
    assert got == sorted(plain_search(docs, items), key=str)
    assert len({r for r in got if r[0] == 6}) == 1
    none = frame.limit(0)
    assert as_rows(ims.search_documents(none, asked)) == []
    assert as_rows(ims.search_documents(frame, asked.limit(0))) == []


def test_small_segments_and_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join(rng.choices(words, weights=range(1, 61), k=rng.randint(1, 40)))) for k in range(400)]
    docs += [(1000 + k, docs[0][1]) for k in range(100)]
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(15)]
    want = sorted(plain_search(docs, items, 7), key=str)
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert as_rows(ims.search_documents(frame, asked, 7)) == want
    monkeypatch.setattr(ims, "ITEM_BLOCK_BYTES", 200)
    assert as_rows(ims.search_documents(frame, asked, 7)) == want


def test_one_index_serves_any_items(spark):
    rng = random.Random(4)
    docs = [(k, " ".join(rng.choices("abcdefghij", k=rng.randint(1, 9)))) for k in range(200)]
    items = [(1, "a b c"), (2, "j i"), (3, "q")]
    index = ims.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    asked = ims.item_terms(spark.createDataFrame(items, "item_id long, text string")).collect()
    assert as_rows(ims.search(index, asked)) == sorted(plain_search(docs, items), key=str)


def test_interval_reading_equals_full_sums():
    rng = np.random.default_rng(5)
    for trial in range(60):
        n, k = int(rng.integers(1, 900)), int(rng.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(rng.integers(1, 9))):
            docs = rng.permutation(n)[: rng.integers(0, n + 1)]
            impact = np.sort(rng.integers(0, 6 if trial % 2 else 100_000, len(docs)))[::-1].astype(np.int64)
            lists.append((docs, impact))
            total[docs] += impact
        bar = int(rng.integers(0, 2)) * int(total.max(initial=0) // 2)
        found, scores = ims.nra(lists, n, k, bar)
        assert (total[found] == scores).all()
        kth = np.sort(total)[::-1][min(k, n) - 1]
        must = np.flatnonzero((total >= max(kth, bar, 1)))
        assert set(must) <= set(found.tolist())


def test_frequent_tail_is_not_read(monkeypatch):
    """A rare high-impact term closes the result before the long list of a common one is read to its end for all documents."""
    n = 100_000
    rare = (np.arange(20), np.full(20, 10_000, np.int64))
    common = (np.arange(n), np.sort(np.random.default_rng(1).integers(1, 50, n))[::-1])
    found, scores = ims.nra([rare, common], n, 10)
    total = common[1].copy()
    total[:20] += 10_000
    assert set(np.argsort(-total, kind="stable")[:10]) <= set(found.tolist())
    assert (scores == total[found]).all() and len(found) < 100
