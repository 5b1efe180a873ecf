import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers as P
import tiktoken

from riskloom.llm import bpe_matrix, host_rules as hr
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA
from tests.llm.test_content_sort import norm
from tests.llm.test_host_rules import plain_counts
from tests.llm.test_mixing import plain_mix
from tests.llm.test_simhash_grid import plain_components, plain_fingerprint


def plain_quality(docs):
    """Documents that pass, judged in plain Python with the same prior."""
    measured = {d: plain_counts(t) for d, t, _ in docs}
    failed = {d: m[0] < 50 or 100 * m[4] > 50 * m[0] for d, m in measured.items()}
    soft = {d: 100 * m[2] > 10 * m[1] or m[3] > 5 for d, m in measured.items()}
    n, f = Counter(s for _, _, s in docs), Counter(s for d, _, s in docs if failed[d])
    rates = [f[s] / n[s] for s in n]
    mean = sum(rates) / len(rates)
    a, b = hr.beta_prior(len(n), len(docs), sum(f.values()), mean, sum((r - mean) ** 2 for r in rates) / len(rates), sum(1 / n[s] for s in n) / len(n))
    bad = {s: round((f[s] + a) / (n[s] + a + b), 9) > 0.5 for s in n}
    return [(d, t, s) for d, t, s in docs if not failed[d] and not (bad[s] and soft[d])]


def plain_run(docs):
    docs = plain_quality(docs)
    groups = {}
    for d, t, s in sorted(docs):
        groups.setdefault(norm(t), (d, t, s))
    docs = list(groups.values())
    component = plain_components([(d, plain_fingerprint(t)) for d, t, _ in docs])
    docs = [r for r, c in zip(docs, component) if r[0] == c]
    mix = plain_mix(docs)
    ranks = bpe_matrix.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, t, _ in docs:
        size, _, _, taken = mix[d]
        copies = taken // size + (2 * (taken % size) >= size)
        ids = library.encode_ordinary(t)
        row = (d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        out += [row] * copies
    return sorted(out)


def test_run_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = corpus_pipeline.run(spark, DATA).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == plain_run(docs)


def test_stages_take_empty_tables_and_keep_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_registered(spark):
    import __spark_entry__ as contract

    assert set(LLM_QUERIES) <= set(contract.queries()) and "pipeline" in contract.queries()
    assert {int(n[2:].split("_")[0]) for n in LLM_QUERIES} == set(range(1, 14))
