import random

import numpy as np

from riskloom.llm import jaccard_join as jj
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA

WHITE = " \t\n\x0b\x0c\r"


def plain_set(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if len(words) < 5:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[k:k + 5]) for k in range(len(words) - 4))


def plain_links(sets):
    """All linked pairs (positions) of distinct sets that share an n-gram."""
    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    pairs = {(i, j) for at in holders.values() for x, i in enumerate(at) for j in at[x + 1:]}
    return {(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


def plain_components(docs):
    """[(doc_id, n_shingles, component_id)] by all pairs."""
    sets = [plain_set(t) for _, t in docs]
    names = {s: k for k, s in enumerate(sorted(set(sets), key=sorted))}
    distinct = sorted(set(sets), key=sorted)
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in plain_links(distinct):
        root[find(i)] = find(j)
    least = {}
    for (d, _), s in zip(docs, sets):
        if d is not None:
            r = find(names[s])
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(find(names[s])) if s else d) for (d, _), s in zip(docs, sets)]


def as_rows(df, id_col="id"):
    return sorted(((r[id_col], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def near_copies(rng, base, n, most=6):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(words))
            what = rng.random()
            if what < 0.4:
                words[at] = f"x{rng.randrange(10**6)}"
            elif what < 0.7:
                del words[at]
            else:
                words.insert(at, f"y{rng.randrange(10**6)}")
        out.append(" ".join(words))
    return out


def corpus(seed, groups=12, copies=25):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    texts = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(20, 200))
        if g % 3 == 0:
            base = base[:30] + passage + base[30:]
        texts += near_copies(rng, base, copies if g else 6 * copies)
    texts += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(2, 30))) for _ in range(60)]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(150)]
    texts += rng.choices(texts, k=60)
    rng.shuffle(texts)
    return [(k, t) for k, t in enumerate(texts)]


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert as_rows(LLM_QUERIES["op12_jaccard_join"](spark, DATA), "doc_id") == sorted(plain_components(docs), key=str)


def test_planted_groups_in_long_and_split_lists(spark, monkeypatch):
    docs = corpus(7)
    want = sorted(plain_components(docs), key=str)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert as_rows(jj.near_classes(frame)) == want
    monkeypatch.setattr(jj, "SHARD_GRAMS", 3000)
    monkeypatch.setattr(jj, "RANGE_GRAMS", 500)
    monkeypatch.setattr(jj, "COMMON", 2)
    monkeypatch.setattr(jj, "SCAN_RUN", 4)
    monkeypatch.setattr(jj, "BLOCK_ROWS", 16)
    assert as_rows(jj.near_classes(frame)) == want


def test_every_pair_of_different_texts(spark, monkeypatch):
    docs = corpus(8, groups=6, copies=12)
    sets = sorted({plain_set(t) for _, t in docs} - {frozenset()}, key=sorted)
    monkeypatch.setattr(jj, "SCAN_RUN", 4)
    monkeypatch.setattr(jj, "BLOCK_ROWS", 16)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    shared = jj.shared_grams(frame)
    members = shared.where("kind = 0 AND n > 0")
    classes = members.groupBy("n", "d1", "d2").agg({"row": "min"}).withColumnRenamed("min(row)", "rep")
    found = jj.similar_pairs(jj.prefixes_of(shared, classes), every=True).collect()
    text_of = dict(docs)
    of_row = {r["row"]: plain_set(text_of[r["id"]]) for r in members.collect()}
    name = {s: k for k, s in enumerate(sets)}
    got = [tuple(sorted((name[of_row[r["a"]]], name[of_row[r["b"]]]))) for r in found]
    assert len(got) == len(set(got))
    assert set(got) == plain_links(sets)


def test_edge_cases(spark):
    long_text = " ".join(f"t{k}" for k in range(400_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE\ttwo"), (None, "one two"), (7, "one two three"), (8, "a b c d e"), (9, "A B C D E"),
            (9, "a b c d e"), (None, None), (10, "É è"), (11, "é è"), (12, long_text), (13, long_text + " end"), (14, "a b c d e a b c d e"), (None, "only null")]
    frame = spark.createDataFrame([(d, t, 1, 2, "x", 3) for d, t in docs], "doc_id long, text string, row long, kind long, data string, n long")
    assert as_rows(jj.near_classes(frame)) == sorted(plain_components(docs), key=str)
    assert as_rows(jj.near_classes(frame.limit(0))) == []


def test_hashes_over_chunks_equal_one_piece(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(3000))
    whole = jj.gram_hashes(text)
    assert len(whole) == len(plain_set(text))
    for size in (1, 7, 100, 5000):
        monkeypatch.setattr(jj, "_CHUNK", size)
        assert np.array_equal(jj.gram_hashes(text), whole)
