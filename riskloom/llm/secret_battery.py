"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests.

Patterns give the base spans. Every other run of 20 or more key characters is tested,
cut at each "=" that is not padding at its end, so that the value in ``NAME=value`` is
tested alone; where no alphabet holds all its characters ("/" or "+" together with "_"
or "-"), its longest parts of 20 or more that have one are. Not tested are values
without a letter, values of one case that hold more than letters and digits of one
alphabet, and values with fewer than two digits whose share of the rarer case (or, in
one case, of digits) would be this small by chance less often than ``least_p``.

A value's encoding is inferred from its characters; a chi-squared test says how far
its characters are from a uniform use of that alphabet, a runs test whether values
above and below the middle alternate as chance would have it, and a serial correlation
test whether neighbours depend on each other. A token of ordinary structure (words, paths,
counters) uses few characters often, which the chi-squared statistic shows more
clearly the longer the token is; the probability that structure looks as even as the
token does is its p-value. Within a document, tokens are accepted by
Benjamini-Hochberg with weights by length, so that long tokens, for which the test is
strong, are not lost to short ones and the expected share of false finds is bounded.

Results by case: a null text counts as empty and has no spans; no rows give no rows;
repeated rows are scanned one by one; a null identifier is kept; other columns are
not read. Positions are code points of the whole text, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The base patterns, their least lengths and their order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_RUN = 20
_VALUE = re.compile(r"[A-Za-z0-9+/_-]+(?:=+\Z)?")
_PARTS = (re.compile(r"[A-Za-z0-9+/]+(?:=+\Z)?"), re.compile(r"[A-Za-z0-9_-]+(?:=+\Z)?"))

# Alphabets by encoding, the narrowest first, in their usual order of values.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_VALUES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}


@dataclass(frozen=True)
class BatteryPolicy:
    """``structure``: how uneven structured text is (chi-squared per character over a uniform source);
    ``false_share``: expected share of false finds; ``least_p``: below it a test rejects randomness."""

    structure: float = 2.0
    false_share: float = 0.01
    least_p: float = 0.002


def _at_most(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` of ``n`` characters being of a kind that has a share ``p``."""
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))


def encoding(token: str, least_p: float = 0.002) -> str | None:
    """Narrowest alphabet that holds a token; None where characters or their mix do not look like a key."""
    body = token.rstrip("=")
    chars = set(body)
    digits = sum(c.isdigit() for c in body)
    lower, upper = sum(c.islower() for c in body), sum(c.isupper() for c in body)
    if not lower + upper:
        return None
    name = next((n for n, a in _VALUES.items() if chars <= a.keys()), None)
    if name is None or name in ("base62", "base64", "base64url") and not (lower and upper):
        return None
    if digits < 2:  # words, too, have few digits; what else they are short of must be as chance has it
        if lower and upper:
            p = _at_most(min(lower, upper), lower + upper, 0.5)
        else:
            p = _at_most(digits, len(body), sum(c.isdigit() for c in ALPHABETS[name]) / len(ALPHABETS[name]))
        if p < least_p:
            return None
    return name


def tokens(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Spans to test in a run of key characters: its values, or their longest parts that have an alphabet."""
    found = []
    for m in _VALUE.finditer(text[start:end]):
        chars = set(m[0].rstrip("="))
        parts = [m.span()]
        if chars & set("+/") and chars & set("-_"):
            both = {(m.start() + x.start(), m.start() + x.end()) for part in _PARTS for x in part.finditer(m[0])}
            parts, reached = [], 0
            for a, b in sorted(both, key=lambda s: (s[0], -s[1])):
                if b > reached:  # not inside another part
                    parts.append((a, b))
                    reached = b
        found += [(start + a, start + b) for a, b in parts if b - a >= LEAST_RUN]
    return found


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(values: list[int], size: int, structure: float) -> tuple[float, float, float, float]:
    """(p of structure, p of chi-squared, p of runs, p of serial correlation) for symbol values below ``size``."""
    n, df = len(values), size - 1
    chi = size / n * sum(c * c for c in Counter(values).values()) - n
    # cube-root transform of a chi-squared value to a normal one
    p_chi = _normal_tail(((max(chi, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    shift = n * structure
    p_structure = _normal_tail((df + shift - chi) / math.sqrt(2 * (df + 2 * shift)))
    high = [v >= size / 2 for v in values]
    a = sum(high)
    b = n - a
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
        mean = 1 + 2 * a * b / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * _normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    m = sum(values) / n
    spread = sum((v - m) ** 2 for v in values)
    serial = sum((x - m) * (y - m) for x, y in zip(values, values[1:])) / spread if spread else 1.0
    p_serial = 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n))
    return p_structure, p_chi, p_runs, p_serial


def accepted(p: list[float], lengths: list[int], share: float) -> list[bool]:
    """Benjamini-Hochberg with weights in proportion to length."""
    if not p:
        return []
    mean = sum(lengths) / len(lengths)
    scaled = [x * mean / n for x, n in zip(p, lengths)]
    order = sorted(range(len(p)), key=scaled.__getitem__)
    last = max((k + 1 for k, i in enumerate(order) if scaled[i] <= share * (k + 1) / len(p)), default=0)
    chosen = set(order[:last])
    return [i in chosen for i in range(len(p))]


def _base(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans; long hex runs lie inside runs of key characters."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    for a, b in runs:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b) if m.end() - m.start() >= LEAST_HEX]
    return found


def spans(text: str, policy: BatteryPolicy = BatteryPolicy()) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all secrets of a text, ordered."""
    runs = [m.span() for m in _RUN.finditer(text)]
    base = _base(text, runs)
    tested = []
    for a, b in (span for run in runs for span in tokens(text, *run)):
        name = encoding(text[a:b], policy.least_p)
        if name and not any(s < b and a < e for s, _, e in base):
            values = [_VALUES[name][c] for c in text[a:b].rstrip("=")]
            tested.append((a, b, battery(values, len(ALPHABETS[name]), policy.structure)))
    passed = accepted([t[2][0] for t in tested], [b - a for a, b, _ in tested], policy.false_share)
    random: list[tuple[int, int, int]] = []
    for (a, b, p), ok in zip(tested, passed):
        if ok and min(p[1:]) >= policy.least_p:
            if random and a < random[-1][2]:  # two parts of one run that overlap
                a = random.pop()[0]
            random.append((a, 3, b))
    return sorted(base + random)


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", policy: BatteryPolicy = BatteryPolicy()) -> DataFrame:
    """One row per row of ``docs``: id, count by kind, base_sha256, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [spans(t or "", policy) for t in b.column(1).to_pylist()]
            counts = [Counter(k for _, k, _ in r) for r in rows]
            base = [hashlib.sha256(_joined([s for s in r if s[1] < 3]).encode()).hexdigest() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)), pa.array(base, pa.string()), pa.array([_joined(r) for r in rows], pa.string())],
                names=["id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
