"""Quality rules by document and by host, in DataFrame functions only.

Every document gets a few counts from its whole text and four rule outcomes. Failures
are added up by host and rule. Each rule has a beta prior of its own, fitted to all
hosts by the method of moments, so a host's rate is shrunk towards the rule's common
rate, the more so the fewer documents the host has. A host is rejected if for some rule
the posterior probability that its rate lies above ``HostPolicy.excess`` times the
common rate is at least ``HostPolicy.certainty`` (the beta posterior by a normal
distribution of its mean and variance). The verdict is joined back: on a rejected host,
a document must also pass the soft rules.

Results by case: a null text has no words and fails; a null host is a host of its
own; no rows give no rows; repeated rows are judged one by one; other columns are
kept by ``passing`` and not read by ``judged``.

Repeated three-word windows are found by sorting one long array per document, whose
values hold a hash of the window above the window's position. Windows whose hash
bits agree are compared word by word; if a document has two different windows with
equal bits (or 2**24 words), its windows are sorted as texts instead, so the count
is exact in all cases.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import SPACES, numbered_names
from riskloom.session import materialize

# The base rules and the characters counted as symbols.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"

POSITION_BITS = 24
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("too_short", "repetitive", "symbol_heavy", "line_copies")


@dataclass(frozen=True)
class HostPolicy:
    """Limits of the soft rules and of the host verdict."""

    most_symbols_percent: int = 10       # of word characters
    most_line_copies: int = 5            # repeated lines that a document may have
    excess: float = 1.25                 # of the common rate of a rule, that a host's rate may reach
    certainty: float = 0.95              # posterior probability from which a host counts as above that

    @property
    def deviations(self) -> float:
        """Standard deviations between the limit and the posterior mean at that certainty, to three places."""
        return round(NormalDist().inv_cdf(self.certainty), 3)


def _any_equal(left: Column, right: Column) -> Column:
    return F.coalesce(F.shiftright(left.bitwiseXOR(right), POSITION_BITS) == 0, F.lit(False))


def _same_window(words: Column, left: Column, right: Column) -> Column:
    same = F.lit(True)
    for k in range(3):
        same = same & (F.get(words, left + k) == F.get(words, right + k))
    return same


def _covered(positions: Column) -> Column:
    """Words covered by three-word windows at the given sorted positions."""
    steps = F.transform(positions, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(positions, k + 1) - p, F.lit(3))).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def _with_repeats(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add the number of words in three-word windows that a document has twice or more."""
    w = F.col(words)
    mask = (1 << POSITION_BITS) - 1
    keys = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")),
    )
    df = df.withColumn("_hr_keys", F.sort_array(keys))
    k = F.col("_hr_keys")
    df = df.withColumn("_hr_met", F.filter(k, lambda x, i: _any_equal(x, F.get(k, i - 1)) | _any_equal(x, F.get(k, i + 1))))
    m = F.col("_hr_met")
    position = lambda x: x.bitwiseAND(F.lit(mask)).cast("int")
    clash = F.exists(
        F.transform(m, lambda x, i: F.when(_any_equal(x, F.get(m, i - 1)), ~_same_window(w, position(x), position(F.get(m, i - 1)))).otherwise(False)),
        lambda x: F.coalesce(x, F.lit(False)),
    )
    df = df.withColumn("_hr_exact", (F.size(w) >= (1 << POSITION_BITS)) | clash)
    texts = F.when(
        F.col("_hr_exact"),
        F.sort_array(F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.struct(x.alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i")))),
    )
    df = df.withColumn("_hr_texts", texts)
    t = F.col("_hr_texts")

    def alike(x, y):
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    slow = F.transform(F.filter(t, lambda x, i: alike(x, F.get(t, i - 1)) | alike(x, F.get(t, i + 1))), lambda x: x["i"])
    df = df.withColumn("_hr_at", F.sort_array(F.when(F.col("_hr_exact"), slow).otherwise(F.transform(m, position))))
    return df.withColumn(out, _covered(F.col("_hr_at"))).drop("_hr_keys", "_hr_met", "_hr_exact", "_hr_texts", "_hr_at")


def _with_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Add the counts, named with the prefix ``_hr_`` so that no column of ``df`` clashes."""
    blank = " \t\n\x0b\x0c\r"
    df = df.withColumn("_hr_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    trimmed = F.btrim("_hr_text", F.lit(blank))
    df = df.withColumn("_hr_words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES)))
    lines = F.filter(F.split("_hr_text", "\n"), lambda line: F.btrim(line, F.lit(blank)) != "")
    df = df.withColumn("_hr_lines", lines)
    df = _with_repeats(df, "_hr_words", "_hr_n_repeat_words")
    return df.withColumns({
        "_hr_n_words": F.size("_hr_words").cast("long"),
        "_hr_word_chars": F.length(F.array_join("_hr_words", "")).cast("long"),
        "_hr_n_symbols": F.regexp_count("_hr_text", F.lit(SYMBOLS)).cast("long"),
        "_hr_n_dup_lines": (F.size("_hr_lines") - F.size(F.array_distinct("_hr_lines"))).cast("long"),
    }).drop("_hr_text", "_hr_words", "_hr_lines")


def _with_rules(df: DataFrame, policy: HostPolicy) -> DataFrame:
    c = {n: F.col(f"_hr_{n}") for n in COUNTS}
    return df.withColumns({
        "_hr_too_short": c["n_words"] < LEAST_WORDS,
        "_hr_repetitive": 100 * c["n_repeat_words"] > MOST_REPEATED_PERCENT * c["n_words"],
        "_hr_symbol_heavy": 100 * c["n_symbols"] > policy.most_symbols_percent * c["word_chars"],
        "_hr_line_copies": c["n_dup_lines"] > policy.most_line_copies,
    }).withColumn("_hr_base_failed", F.col("_hr_too_short") | F.col("_hr_repetitive"))


def host_verdicts(ruled: DataFrame, policy: HostPolicy) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and verdict by rule, and the verdict over all rules.

    The priors' parameters come from sums over hosts, one row for the driver.
    """
    hosts = materialize(
        ruled.groupBy(F.col("_hr_host").alias("_hr_h")).agg(
            F.count(F.lit(1)).alias("documents"), *(F.sum(F.col(f"_hr_{r}").cast("long")).alias(r) for r in RULES)
        ),
        "hosts",
    )
    n = F.col("documents")
    s = hosts.agg(
        F.count(F.lit(1)).alias("k"), F.sum("documents").alias("n"), F.avg(1 / n).alias("inv"),
        *(F.sum(r).alias(f"f_{r}") for r in RULES), *(F.avg(F.col(r) / n).alias(f"m_{r}") for r in RULES), *(F.var_pop(F.col(r) / n).alias(f"v_{r}") for r in RULES),
    ).first()
    out = hosts
    for r in RULES:
        alpha, beta = beta_prior(s["k"], s["n"], s[f"f_{r}"], s[f"m_{r}"], s[f"v_{r}"], s["inv"])
        weight = n + F.lit(alpha + beta)
        mean = (F.col(r) + F.lit(alpha)) / weight
        spread = F.sqrt(mean * (1 - mean) / (weight + 1))
        limit = F.lit(policy.excess * (s[f"f_{r}"] or 0) / (s["n"] or 1))
        out = out.withColumns({f"{r}_rate": mean, f"{r}_rejected": F.round((mean - limit) / spread, 6) >= policy.deviations})
    return out.withColumn("host_rejected", reduce(Column.__or__, (F.col(f"{r}_rejected") for r in RULES)))


def beta_prior(hosts: int, documents: int | None, failed: int | None, mean: float | None, variance: float | None, mean_inverse: float | None) -> tuple[float, float]:
    """Beta parameters by moments: the variance between hosts, less what chance within a host gives.

    Without hosts, or where all rates are alike, the prior counts as one average host.
    """
    if not hosts or not documents:
        return 1.0, 1.0
    m = min(max(failed / documents, 1e-6), 1 - 1e-6)
    between = variance - m * (1 - m) * mean_inverse
    weight = m * (1 - m) / between - 1 if between > 1e-12 else documents / hosts
    weight = min(max(weight, 1.0), documents / hosts)
    return m * weight, (1 - m) * weight


def _decided(staged: DataFrame, policy: HostPolicy) -> DataFrame:
    verdicts = host_verdicts(staged, policy).select(
        "_hr_h", F.col("host_rejected").alias("_hr_bad_host"), *(F.col(f"{r}_rate").alias(f"_hr_{r}_rate") for r in RULES)
    )
    soft = F.col("_hr_symbol_heavy") | F.col("_hr_line_copies")
    return staged.join(verdicts, F.col("_hr_host").eqNullSafe(F.col("_hr_h")), "left").withColumn(
        "_hr_kept", ~F.col("_hr_base_failed") & ~(F.col("_hr_bad_host") & soft)
    )


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", policy: HostPolicy = HostPolicy()) -> DataFrame:
    """One row per row of ``docs``: id, host, counts, rule outcomes, the host's shrunk rate by rule and the verdicts.

    The counts are written once (numbers only), then read for the host totals and
    for the join.
    """
    narrow = docs.select(F.col(id_col).alias("_hr_id"), F.col(host_col).cast("string").alias("_hr_host"), F.col(text_col).alias("_hr_in"))
    ruled = _with_rules(_with_counts(narrow, "_hr_in"), policy).drop("_hr_in")
    out = _decided(materialize(ruled, "host-rules"), policy)
    names = {"_hr_id": "id", "_hr_host": "host", **{f"_hr_{n}": n for n in (*COUNTS, *RULES, "base_failed", *(f"{r}_rate" for r in RULES), "kept")}, "_hr_bad_host": "host_rejected"}
    return out.select(*(F.col(a).alias(b) for a, b in names.items()))


def passing(docs: DataFrame, text_col: str = "text", host_col: str = "source", policy: HostPolicy = HostPolicy()) -> DataFrame:
    """Rows of ``docs`` that stay, with their columns as they were."""
    names = docs.columns
    docs, (text_col, host_col) = numbered_names(docs, text_col, host_col)
    ruled = _with_rules(_with_counts(docs.withColumn("_hr_host", F.col(host_col).cast("string")), text_col), policy)
    return _decided(materialize(ruled, "host-rules-docs"), policy).where("_hr_kept").select(*docs.columns).toDF(*names)
