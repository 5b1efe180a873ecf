import random
import uuid
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from riskloom.llm import token_store as ts
from riskloom.llm.queries import LLM_QUERIES
from riskloom.session import shared_dir
from tests.conftest import DATA

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_chunks_encode_as_whole_texts(library):
    rng = random.Random(4)
    letters = list(" \n\t',.sdmABCabc12!?$é÷日 ́\x1c\x0b")
    texts = ["", " ", "a, b.\nC d.\n\nE", "a÷, b", "x \n y\n z", "<|endoftext|> a", "it's, ok."]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4000)]
    got = ts.Encoder(PATH).encode(texts)
    for text, data in zip(texts, got):
        assert np.frombuffer(data, "<u4").tolist() == library(text), repr(text)


def test_other_tokenizers_get_whole_texts():
    encoder = ts.Encoder(P.path("word_bpe_49k.json"))
    assert not encoder.chunked
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    assert np.frombuffer(encoder.encode(["Some words, here."])[0], "<u4").tolist() == t.encode("Some words, here.", add_special_tokens=False).ids


def test_query_equals_library(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = [], 0
    for r in docs:
        ids = library(r.text or "") + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in LLM_QUERIES["op8_token_store"](spark, DATA).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want


def store(spark, docs):
    path = f"{shared_dir(spark)}/test-store-{uuid.uuid4().hex}"
    ts.write_store(docs, path, PATH)
    return path


def test_single_documents_by_offset(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    path = store(spark, docs)
    some = {r.doc_id: r.text for r in docs.where("doc_id IN (0, 17, 150)").collect()}
    got = {r.id: r.ids for r in ts.fetch(spark, path, some).collect()}
    assert got == {d: library(t or "") + [0] for d, t in some.items()}
    assert len(ts._dictionary(spark, path)[1]) > 0


def test_nulls_ties_empty_tables_and_extra_columns(spark, library):
    docs = spark.createDataFrame([(5, "b b", 1), (5, "a a", 2), (5, "a a", 2), (None, "n", 3), (2, None, 4), (9, "long " * 40_000, 5)], "doc_id long, text string, id int")
    rows = sorted(ts.read_store(spark, store(spark, docs), keep_ids=True).collect(), key=lambda r: r.start)
    assert [r.id for r in rows] == [None, 2, 5, 5, 5, 9]
    assert rows[0].ids == library("n") + [0] and rows[1].ids == [0]
    assert sorted(r.ids for r in rows[2:5]) == sorted([library("a a") + [0]] * 2 + [library("b b") + [0]])
    assert rows[5].ids == library("long " * 40_000) + [0]
    assert [r.start for r in rows] == np.append(0, np.cumsum([r.n_tokens for r in rows]))[:-1].tolist()
    assert ts.read_store(spark, store(spark, docs.where("false"))).count() == 0


def test_another_dictionary_is_refused(spark):
    frames = ts._read_frames("other", b"", None, False)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([[1]]), pa.array([[0, 1]]), pa.array([[1]]), pa.array([0]), pa.array([0]), pa.array(["mine"]), pa.array([b"x"])], names=ts._READ)
    with pytest.raises(ValueError, match="another dictionary"):
        list(frames(iter([batch])))
