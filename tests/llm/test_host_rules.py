import random
import re

import duckdb
import pytest

from riskloom.llm import host_rules as hr
from riskloom.llm.queries import LLM_ORACLES, LLM_QUERIES
from tests.conftest import DATA

SPACE = "[ \t\n\x0b\x0c\r]+"


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.sub(SPACE, "", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def counts(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cursor = con.execute(LLM_ORACLES["op5_host_quality_rules"])
    names = [d[0] for d in cursor.description]
    rows = LLM_QUERIES["op5_host_quality_rules"](spark, DATA).select(*names).collect()
    assert sorted(map(tuple, rows)) == sorted(cursor.fetchall())


def test_the_plan_runs_no_python(spark):
    plan = LLM_QUERIES["op5_host_quality_rules"](spark, DATA)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("bits", [24, 4])
def test_counts_equal_brute_force(spark, monkeypatch, bits):
    """With few position bits windows clash and documents are too long for them, so the exact way is taken."""
    monkeypatch.setattr(hr, "POSITION_BITS", bits)
    rng = random.Random(8)
    words = ["a", "b", "c", "É", "#x", "<p>", "日本"]
    texts = ["", None, " \n\t ", "a", "a b", "a b c", "a b c a b c", "x\nx\n\nx \n x", "\x0ba\x0cb\rc", "a b c d e"]
    texts += ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    texts.append(" ".join(f"w{i % 5000}" for i in range(12_000)))
    frame = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.id: counts(r) for r in hr.judged(frame).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


GOOD = " ".join(f"w{i}" for i in range(60))
SYMBOLS = " ".join(f"w{i}##" for i in range(60))
LINES = "\n".join([" ".join(f"w{i}" for i in range(60))] + ["the same line"] * 8)


def test_hosts_that_fail_a_rule_are_rejected(spark):
    """One host fails the length rule, one the symbol rule; each rule has its own rate and prior."""
    rows = [(i, GOOD if i // 20 % 10 else "short", f"plain{i % 20}") for i in range(1000)]
    rows += [(2000 + i, "short", "brief") for i in range(90)] + [(2100, GOOD, "brief"), (2101, SYMBOLS, "brief"), (2102, LINES, "brief")]
    rows += [(3000 + i, SYMBOLS, "signs") for i in range(40)] + [(3100, GOOD, "signs"), (3101, LINES, "signs")]
    rows += [(4001, SYMBOLS, "plain1"), (4002, LINES, "plain2")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.id: r for r in hr.judged(frame).collect()}
    assert {r.host for r in got.values() if r.host_rejected} == {"brief", "signs"}
    assert got[2100].kept and not got[2101].kept and not got[2102].kept and not got[2101].base_failed
    assert got[3100].kept and not got[3000].kept and not got[3101].kept and got[3000].symbol_heavy_rate > got[3000].too_short_rate
    assert got[4001].kept and got[4002].kept
    assert not any(r.kept for r in got.values() if r.base_failed)
    kept = hr.passing(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)


def test_shrinkage_saves_a_small_host(spark):
    """All of a small host's documents fail a rule, as do all of a large one's; only the large one is rejected."""
    rows = [(i, GOOD if i // 20 % 5 else SYMBOLS, f"plain{i % 20}") for i in range(1000)]
    rows += [(2000 + i, SYMBOLS, "large") for i in range(40)] + [(3000, SYMBOLS, "small"), (3001, SYMBOLS, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.id: r for r in hr.judged(frame).collect()}
    assert got[2000].host_rejected and not got[2000].kept
    for i in (3000, 3001):
        assert not got[i].host_rejected and got[i].kept and got[i].symbol_heavy and got[i].symbol_heavy_rate < 1


def test_a_longer_text_than_any(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    frame = spark.createDataFrame([(1, text, "s"), (2, text + " " + text, "s")], "doc_id long, text string, source string")
    got = {r.id: (r.n_words, r.n_repeat_words, r.kept) for r in hr.judged(frame).collect()}
    assert got == {1: (300_000, 0, True), 2: (600_000, 600_000, False)}


def test_prior():
    assert hr.beta_prior(0, None, None, None, None, None) == (1.0, 1.0)
    a, b = hr.beta_prior(10, 1000, 100, 0.1, 0.01, 0.01)
    assert a / (a + b) == pytest.approx(0.1) and a + b == pytest.approx(0.09 / (0.01 - 0.0009) - 1)
    assert sum(hr.beta_prior(4, 400, 0, 0.0, 0.0, 0.01)) == pytest.approx(100)


def test_ties_empty_tables_and_extra_columns(spark):
    frame = spark.createDataFrame([(1, "a b c", "s", 1), (1, "a b c", "s", 1), (None, None, None, 2)], "doc_id long, text string, source string, kept int")
    assert sorted((str(r.id), r.n_words, r.kept) for r in hr.judged(frame).collect()) == [("1", 3, False), ("1", 3, False), ("None", 0, False)]
    assert hr.passing(frame).columns == frame.columns
    none = frame.where("false")
    assert hr.judged(none).count() == 0 and hr.passing(none).count() == 0
