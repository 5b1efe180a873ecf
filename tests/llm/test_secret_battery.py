import base64
import hashlib
import random
import re

from riskloom.llm import secret_battery as sb
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA


def plain_base(text):
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def check(row, text):
    base = plain_base(text)
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
    assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
    assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert [s for s in row.spans.split(",") if s and not s.startswith("random")] == [s for s in joined.split(",") if s]


def test_query_equals_plain_patterns(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = LLM_QUERIES["op9_secret_battery"](spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        check(r, docs[r.doc_id])
    assert sum(r.n_random for r in rows) <= len(docs) // 100


def test_base_patterns():
    odd = [
        'PassWord: "abc123"', "paſſword=abcdef", "api_key=short", "apiKEY = 'longer.value-1'", "toKen=abcdefg", "AKIA" + "A" * 15, "AKIA" + "A" * 16,
        "AKIAAKIA" + "B" * 20, "f" * 23, "f" * 24, "é" * 5 + "0" * 24 + "g", "token=token=abcdef", "secret=a secret=abcdefg", "x" * 30 + "a" * 24, "",
    ]
    for text in odd:
        assert [s for s in sb.spans(text) if s[1] < 3] == plain_base(text), text


def test_random_tokens_are_found_and_words_are_not():
    rng = random.Random(3)
    found = false = 0
    words = ["configuration", "Version", "release", "Handler", "2024", "final", "node", "17"]
    for _ in range(200):
        key = base64.b64encode(rng.randbytes(30)).decode()
        found += any(k == 3 for _, k, _ in sb.spans(f"see {key} there"))
        name = "_".join(rng.choices(words, k=5)) + "-v12"
        false += any(k == 3 for _, k, _ in sb.spans(f"see {name} there"))
    assert found >= 180 and false <= 4


def test_keys_behind_names_and_paths_and_without_digits():
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    makers = {
        "SIGNING_KEY=": lambda: base64.b64encode(rng.randbytes(30)).decode(),
        "AWS_SECRET_ACCESS_KEY=": lambda: base64.b64encode(rng.randbytes(29)).decode(),  # with padding
        "sig=": lambda: base64.urlsafe_b64encode(rng.randbytes(36)).decode(),
        "path/to_dir/": lambda: "".join(rng.choices(letters + "0123456789", k=40)),
        "": lambda: "".join(rng.choices(letters, k=40)),
    }
    for before, make in makers.items():
        found = 0
        for _ in range(100):
            key = make()
            text = f"see {before}{key} there"
            end = 4 + len(before) + len(key)
            found += any(k == 3 and a <= end - len(key) and b == end for a, k, b in sb.spans(text))
        assert found >= 85, (before, found)
    words = ["configuration", "Version", "release", "Handler", "Manager", "final", "Provider", "account"]
    names = ["".join(rng.choices(words, k=4)) for _ in range(200)] + ["/".join(rng.choices(words, k=3)) + "_" + "".join(rng.choices(words, k=3)) for _ in range(200)]
    assert sum(any(k == 3 for _, k, _ in sb.spans(f"see {n}={n} there")) for n in names) <= 4
    assert sb.spans("aB" * 150_000) == [] and sb.spans("ab/c_" * 60_000) == []


def test_battery_of_structure():
    p = sb.battery([0, 1] * 20, 16, 2.0)
    assert p[0] > 0.5 and min(p[1:]) < 1e-3
    assert sb.battery([3] * 30, 16, 2.0)[2] < 1e-6
    assert sb.accepted([], [], 0.1) == [] and sb.accepted([0.001, 0.9], [20, 20], 0.01) == [True, False]
    assert sb.accepted([0.012, 0.9], [60, 20], 0.02) == [True, False]  # weight by length


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "token=abcdef", None), (5, "ab " * 100_000 + "f" * 30, "z")], "doc_id long, text string, spans string")
    rows = sb.secrets(docs).collect()
    assert sorted(((r.id, r.spans) for r in rows), key=str) == sorted([(1, ""), (2, ""), (2, ""), (None, "assign:0:12"), (5, "hex:300000:300030")], key=str)
    assert sb.secrets(docs.where("false")).count() == 0
