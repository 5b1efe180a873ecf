"""Chat training text rebuilt from an event log.

A conversation is a log of events (conv_id, seq, kind, turn, role, text):

* ``message``: a whole turn; it ends what the turn held before;
* ``delta``: text to append to a turn (its first delta names the role);
* ``edit``: the turn gets this text, and later turns are void;
* ``regenerate``: the turn is emptied, and later turns are void.

A reverse running minimum over the log says which events are void, so that a
conversation of any length is folded without being held in memory: what is left is
sorted by turn and sequence, and one pass joins the pieces of a turn and renders it.
Turns are folded in tasks by (conversation, turn). Three steps stream a conversation
through one task: numbering the rows of a table of turns, the running minimum, and the
digest, of which only the digest is sequential by nature.

Rendered turns look like ``<s>role\\ntext</s>\\n``. Control strings inside texts and
roles get a backslash after their first character and backslashes are doubled, so
they cannot end a turn and come back exactly; a line end in a role is escaped too.
The loss mask covers the texts of assistant turns.

Results by case: null text or role counts as empty; a null kind is a message; a null
turn or sequence comes first; a null conversation is a conversation of its own; events
that share a sequence are ordered by kind, role and text; no rows give no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

# Control strings of this and other chat templates.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
ASSISTANT = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(role: str, text: str) -> tuple[str, int, int]:
    """A rendered turn and its loss span (start, end; empty for all but assistant turns)."""
    head = "<s>" + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    loss = (len(head), len(head) + len(body)) if role == ASSISTANT else (0, 0)
    return f"{head}{body}</s>\n", *loss


def parse(rendered: str) -> tuple[str, str]:
    """(role, text) of one rendered turn."""
    end = re.match(r"<s>(?:[^\\\n]|\\.)*+\n", rendered, re.DOTALL)
    if not end or not rendered.endswith("</s>\n"):
        raise ValueError("not a rendered turn")
    head, body = rendered[3:end.end() - 1], rendered[end.end():-5]
    if _CONTROL.search(body) or _CONTROL.search(head):
        raise ValueError("a control string was left in a turn")
    return unescape(head), unescape(body)


def live_events(log: DataFrame) -> DataFrame:
    """Events that no later edit or regeneration voids."""
    ordered = Window.partitionBy("conv_id").orderBy(
        F.col("seq").desc_nulls_last(), F.col("kind").desc(), F.col("role").desc_nulls_last(), F.col("text").desc_nulls_last()
    )
    after = ordered.rowsBetween(Window.unboundedPreceding, -1)
    starts = F.col("kind").isin("message", "edit", "regenerate")
    cuts = F.col("kind").isin("edit", "regenerate")
    rows = log.withColumn("_ce_cut", F.min(F.when(cuts, F.col("turn"))).over(after))
    # void: a later edit or regeneration of this or an earlier turn
    rows = rows.where(F.col("_ce_cut").isNull() | (F.col("turn") < F.col("_ce_cut")) | F.col("turn").isNull())
    # a message also replaces what its own turn held
    same = Window.partitionBy("conv_id", "turn").orderBy(
        F.col("seq").desc_nulls_last(), F.col("kind").desc(), F.col("role").desc_nulls_last(), F.col("text").desc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_ce_new", F.max(F.when(starts, 1)).over(same)).where(F.col("_ce_new").isNull())
    return rows.drop("_ce_cut", "_ce_new")


_RENDERED = "conv_id long, turn long, role string, rendered string, loss_start long, loss_end long"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns rendered from their pieces; rows come sorted by conversation, turn and sequence."""
    key, role, pieces = None, "", []
    out: list[tuple] = []
    size = 0

    def turn() -> None:
        nonlocal size
        text = "".join(pieces)
        out.append((*key, role, *render(role, text)))
        size += len(text)

    def batch() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv_id", "turn", "role", "rendered", "loss_start", "loss_end"])

    for b in batches:
        for conv, number, kind, who, text in zip(*(c.to_pylist() for c in b.columns)):
            if key != (conv, number) or kind == "message":
                if key is not None:
                    turn()
                key, role, pieces = (conv, number), who or "", []
            role = role or who or ""
            pieces.append(text or "")
            if size > 4_000_000:
                yield batch()
                out, size = [], 0
    if key is not None:
        turn()
    if out:
        yield batch()


def rendered_turns(log: DataFrame) -> DataFrame:
    """(conv_id, turn, role, rendered, loss_start, loss_end): the final turns of every conversation, rendered."""
    rows = log.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"), F.coalesce(F.col("kind").cast("string"), F.lit("message")).alias("kind"),
        F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    live = live_events(rows).repartition("conv_id", "turn").sortWithinPartitions("conv_id", "turn", F.col("seq").asc_nulls_first(), "kind", "role", "text")
    return live.select("conv_id", "turn", "kind", "role", "text").mapInArrow(_fold, _RENDERED)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    first, now = True, None
    n = loss_chars = chars = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def done() -> None:
        out.append((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    for b in batches:
        for conv, rendered, start, end in zip(*(c.to_pylist() for c in b.columns)):
            if first or conv != now:
                if not first:
                    done()
                first, now, n, loss_chars, chars = False, conv, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            role, text = parse(rendered)
            masked = unescape(rendered[start:end])
            n, chars, loss_chars = n + 1, chars + len(rendered), loss_chars + len(masked)
            turns.update(f"{role}\n{text}\n".encode())
            loss.update(masked.encode())
    if not first:
        done()
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = list(zip(*out)) or [()] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its rendered turns."""
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "rendered")
    return ordered.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(_digest, _DIGESTS)


def log_of_turns(conversations: DataFrame) -> DataFrame:
    """The event log of a table of finished turns (conv_id, turn, role, text): a message that opens each turn, and its text as a delta.

    Rows that share a turn number follow each other, ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").withColumn("_ce_n", F.row_number().over(order).cast("long"))
    opened = F.struct(F.lit("message").alias("kind"), F.col("role").alias("role"), F.lit(None).cast("string").alias("text"), (2 * F.col("_ce_n")).alias("seq"))
    filled = F.struct(F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), F.col("text").alias("text"), (2 * F.col("_ce_n") + 1).alias("seq"))
    events = rows.select("conv_id", F.col("_ce_n").alias("turn"), F.explode(F.array(opened, filled)).alias("e"))
    return events.select("conv_id", "e.seq", "e.kind", "turn", "e.role", "e.text")
