import random
import re
from collections import Counter

import numpy as np

from riskloom.llm import phrase_automata as pa_
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA


def pieces_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def plain_counts(docs):
    f, n = {}, Counter()
    for lang, text in docs:
        c = f.setdefault(lang or "und" if lang is None else lang, Counter())
        for w in pieces_of(text):
            n["und" if lang is None else lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        c[tuple(w[i:i + k])] += 1
    return f, n


def plain_collocations(docs, least, best):
    f, n = plain_counts(docs)
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        rows = []
        for p, a in cands.items():
            if inside[p] >= a:
                continue
            s, k = min(((1000 * a * n[lang]) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("lang", "text").collect()]
    want = plain_collocations(docs, 100, 2000)
    assert want and as_rows(LLM_QUERIES["op13_phrase_automata"](spark, DATA)) == want


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["é", "ÉT", "the", "The", "x\x1cy", "日本"]
    weights = [60 / (k + 1) for k in range(len(words) - 4)] + [30, 60, 20, 9]
    docs = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choices(words, weights)[0] + rng.choices([" ", "  ", "\t", ". ", ",", "\n", "\r", "! "], [50, 5, 2, 3, 3, 2, 1, 1])[0]
        if rng.random() < 0.3:
            text += " the quick brown fox jumps over"
        docs.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text))
    return docs


def test_small_ranges_give_the_same(spark, monkeypatch):
    docs = corpus(1)
    want = plain_collocations(docs, 5, 50)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert as_rows(pa_.collocations(frame, least=5, best=50)) == want
    for name, value in {"SHARD_WORDS": 300, "RANGE_WINDOWS": 40, "MERGE_WINDOWS": 100, "SAMPLE_BYTES": 9000}.items():
        monkeypatch.setattr(pa_, name, value)
    assert as_rows(pa_.collocations(frame, least=5, best=50)) == want


def test_edge_cases(spark):
    long_text = "a b c d e f " * 60_000 + "z" * 1_500_000 + " ." + "tail word " * 7
    docs = [("en", None), ("en", ""), (None, "x y, x y. X Y"), ("und", "x y"), ("en", long_text), ("en", ",;:"), ("fr", "seul"), ("en", "a b"), ("en", "a b")]
    frame = spark.createDataFrame([(lang, t, 1, 2, 3) for lang, t in docs], "lang string, text string, phrase long, n long, score long")
    assert as_rows(pa_.collocations(frame, least=3)) == plain_collocations(docs, 3, 2000)
    assert as_rows(pa_.collocations(frame.limit(0))) == []
    assert as_rows(pa_.collocations(frame.where("lang = 'fr'"), least=1)) == []


def test_transducer_round_trip_and_sharing():
    rng = np.random.default_rng(3)
    names = [f"n{k}".encode() for k in range(30)]
    for size in (0, 1, 2, 50, 5000):
        stream = rng.integers(0, 31, size) * (rng.random(size) < 0.9)
        bag = pa_.Bag.of_stream(names, stream.astype(np.int64))
        back = pa_.expand(pa_.build(bag))
        assert back.words == bag.words and (back.counts == bag.counts).all()
        assert all((x == y).all() for x, y in zip(back.columns, bag.columns))
    # windows that differ in their first words only share their tails
    distinct = np.concatenate([[1 + k, 21, 22, 23, 24, 0] for k in range(20)])
    arcs = pa_._unpacked(pa_.build(pa_.Bag.of_stream(names, distinct)).partition(b"\x00ARCS")[2], 4 * pa_.LENGTH)
    assert sum(len(arcs[4 * d + 1]) for d in range(1, pa_.LENGTH)) < 30


def test_union_and_place():
    docs = [d for d in corpus(4, 60) if d[1]]
    bags = []
    for _, text in docs:
        codes = {}
        stream = []
        for p in pieces_of(text):
            stream += [codes.setdefault(w.encode(), len(codes) + 1) for w in p] + [0]
        bags.append(pa_.Bag.of_stream(list(codes), np.array(stream, np.int64)))
    whole = pa_.Bag.union(bags)
    f, _ = plain_counts([("en", t) for _, t in docs])
    got = {whole.text(int(k), length): int(w) for length, first, weight in whole.prefixes() for k, w in zip(first, weight)}
    assert got == {" ".join(p).encode(): c for p, c in f["en"].items()}
    keys = [whole.text(k).split(b" ") for k in range(len(whole))]
    assert keys == sorted(keys)
    for s in ([b"the"], [b"the", b"quick"], [b"zzz"], [b""], [b"w1", b"aa", b"b"], keys[7], keys[-1]):
        assert whole.place(s) == sum(k < s for k in keys)
        cut = whole.place(s)
        halves = [whole.part(0, cut), whole.part(cut, len(whole))]
        again = pa_.Bag.union([h for h in halves if len(h)])
        assert (again.counts == whole.counts).all()
