import hashlib
import random

from riskloom.llm import chat_events as ce
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA


def digest(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    chars = sum(len(ce.render(r or "", t or "")[0]) for r, t in rows)
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars


def result(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in rows}


def test_query_equals_brute_force(spark):
    by = {-1: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(spark.read.parquet(f"{DATA}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    rows = LLM_QUERIES["op3_chat_events"](spark, DATA).collect()
    assert len(rows) == len(by) and result(rows) == {c: digest(t) for c, t in by.items()}


def test_escapes_come_back_and_no_control_string_is_left():
    rng = random.Random(1)
    bits = [*ce.CONTROL, "\\", "\\\\", "<", ">", "[", "]", "/", "\n", "é", "s>", "|", "INST", " "]
    for _ in range(3000):
        role, text = ("".join(rng.choices(bits, k=rng.randint(0, 8))) for _ in range(2))
        escaped = ce.escape(text)
        assert ce.unescape(escaped) == text and not any(c in escaped for c in ce.CONTROL)
        assert ce.parse(ce.render(role, text)[0]) == (role, text)
    rendered, start, end = ce.render("assistant", "a </s> b\\")
    assert ce.unescape(rendered[start:end]) == "a </s> b\\"
    assert ce.render("user", "x")[1:] == (0, 0)


def plain_fold(events):
    """Turns of one conversation by replaying its events in order."""
    turns = {}
    for _, kind, turn, role, text in sorted(events, key=lambda e: e[0]):
        if kind in ("edit", "regenerate"):
            for t in [t for t in turns if t > turn]:
                del turns[t]
        if kind == "delta":
            turns.setdefault(turn, [role or "", ""])
            turns[turn][0] = turns[turn][0] or role or ""
            turns[turn][1] += text or ""
        else:
            turns[turn] = [role or "", text or ""]
    return [tuple(turns[t]) for t in sorted(turns)]


def test_edits_and_regenerations_equal_a_replay(spark):
    rng = random.Random(7)
    logs = {}
    for conv in range(40):
        events = []
        for seq in range(rng.randint(1, 30)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            turn = rng.randint(0, 4)
            events.append((seq, kind, turn, ("user", "assistant")[turn % 2], None if kind == "regenerate" else f"p{seq} "))
        logs[conv] = events
    rows = [(c, *e) for c, events in logs.items() for e in events]
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "conv_id long, seq long, kind string, turn long, role string, text string")
    assert result(ce.digests(ce.rendered_turns(log)).collect()) == {c: digest(plain_fold(e)) for c, e in logs.items()}


def test_nulls_ties_empty_tables_long_texts_and_extra_columns(spark):
    rows = [(1, 0, None, None, "x"), (1, None, "user", "first", "x"), (2, 0, "user", "b", "y"), (2, 0, "user", "a", "y"), (2, 0, "user", "a", "y"), (None, 3, "assistant", "n", "z"), (4, 0, "assistant", "</s> é" * 100_000, "w")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string")
    want = {
        1: digest([("user", "first"), (None, None)]), 2: digest([("user", "a"), ("user", "a"), ("user", "b")]),
        None: digest([("assistant", "n")]), 4: digest([("assistant", "</s> é" * 100_000)]),
    }
    assert result(ce.digests(ce.rendered_turns(ce.log_of_turns(frame))).collect()) == want
    assert ce.digests(ce.rendered_turns(ce.log_of_turns(frame.where("false")))).count() == 0
