import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from riskloom.llm import bpe_matrix as bm
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ours():
    return bm.Codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def library(ours):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def same(ours, library, texts):
    for text, ids in zip(texts, ours.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()


def test_odd_texts(ours, library):
    same(ours, library, [
        "", " ", "a  ", "  a", "\n \n  x", "x  y 　z", "\t b \n c", " 日本語 テキスト", "👍🏽👍 ok", "it's we'LL 'd 123 4567", " ' s",
        "<|endoftext|>", "é ́", " \u0085a \x1c b", "a" * 5000, "ab" * 3000, " " * 700, "x" * 300 + " " + "z" * 257,
    ])


def test_random_texts(ours, library):
    rng = random.Random(1)
    letters = list(" \n\t'sdmABCabc123!?$é日 ́\x1c\x0b")
    same(ours, library, ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(3000)])


def test_long_pieces_merge_in_the_same_order(ours, library):
    rng = random.Random(2)
    same(ours, library, ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(257, 900))) for _ in range(20)])


def test_full_cache_is_emptied(ours, library, monkeypatch):
    monkeypatch.setattr(ours.later, "most", 3)
    same(ours, library, ["one two three four five six seven"])
    same(ours, library, ["five six seven", "one two"])
    assert len(ours.later.keys) <= 3
    same(ours, library, ["one seven eight"])


def test_pair_table(ours):
    a = np.array([ours.ranks[b"t"], -1, ours.ranks[b"t"], 50_000], np.int32)
    b = np.array([ours.ranks[b"h"], 5, -1, 49_999], np.int32)
    assert ours.pairs(a, b).tolist() == [ours.ranks[b"th"], bm.NO_PAIR, bm.NO_PAIR, bm.NO_PAIR]


def test_query_equals_library(spark, ours, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in LLM_QUERIES["op7_bpe_matrix"](spark, DATA).collect()}
    assert got == want


def test_nulls_repeats_empty_tables_and_extra_columns(spark, monkeypatch):
    monkeypatch.setattr(bm, "BATCH_CHARS", 3)
    docs = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, "hello  world", None), (3, "", "b"), (4, "tail", "c")], "doc_id long, text string, ids string")
    tokens = bm.encoded(docs, PATH, P.PATTERN)
    got = {r.id: r.ids for r in tokens.collect()}
    assert got[1] == [] and got[3] == [] and len(got[None]) >= 2 and tokens.count() == 5
    back = sorted(bytes(r.data) for r in bm.decoded(tokens, PATH, P.PATTERN).collect())
    assert back == [b"", b"", b"", b"hello  world", b"tail"]
    assert bm.encoded(docs.where("false"), PATH, P.PATTERN).count() == 0
    assert bm.round_trip(docs.where("false"), PATH, P.PATTERN).count() == 0
