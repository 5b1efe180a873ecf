import random
from datetime import date
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import joins as J, profiles as P, quality as Q, ranks as R, sets as S, windows as W
from riskloom.operators.quantiles import exact_medians, exact_percentiles
from riskloom.plans.monthly import most_common

UNITS = [5, 0, 7, 3, 9, 1, 4, 8]


@pytest.fixture(scope="module")
def history(spark):
    rows = [("p", 1, date(2024, m + 1, 1), float(u)) for m, u in enumerate(UNITS)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "product_id string, region_id int, year_month date, units double")


def by_month(df, col):
    return [r[0] for r in df.orderBy("year_month").select(col).collect()]


def test_history_windows(history):
    h = W.History()
    assert by_month(history.withColumn("x", h.lag("units", 3)), "x")[:4] == [None, None, None, 5.0]
    mean3 = by_month(history.withColumn("x", h.rolling("units", 3, 2)), "x")
    assert mean3[:3] == [None, None, 2.5] and mean3[3] == pytest.approx(4.0)
    std3 = by_month(history.withColumn("x", h.rolling("units", 3, 2, "std")), "x")
    assert std3[3] == pytest.approx(np.std([5, 0, 7], ddof=1))
    slope3 = by_month(history.withColumn("x", h.slope("units", 3)), "x")
    assert slope3[:3] == [None] * 3 and slope3[3:] == pytest.approx([1, 1.5, 1, -1, -2.5])
    slope6 = by_month(history.withColumn("x", h.slope("units", 6)), "x")
    assert slope6[6:] == pytest.approx([0.085714, 0.228571], abs=1e-5)
    gapped = by_month(history.withColumn("x", h.rolling("units", 6, 2, gap=2)), "x")
    assert gapped[:3] == [None] * 3 and gapped[3] == pytest.approx(2.5)
    assert by_month(history.withColumn("x", h.is_last()), "x") == [False] * 7 + [True]


def test_future_rows_never_change_past_features(history):
    h = W.History()
    def built(df):
        return df.withColumns({"a": h.rolling("units", 3, 2), "b": h.slope("units", 3), "c": h.growth("units")})
    cut = history.where("year_month < '2024-06-01'")
    before = built(history).where("year_month < '2024-06-01'")
    assert sorted(map(tuple, built(cut).collect()), key=str) == sorted(map(tuple, before.collect()), key=str)


def test_group_ranks_ties(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 3.0), ("g", 5.0), ("g", None)], "k string, v double")
    got = {r.v: (r.dense_rank, r.min_rank, r.rank_share) for r in R.group_ranks(df, ["k"], "v").collect()}
    assert got == {1.0: (1, 1, 0.375), 3.0: (2, 3, 0.75), 5.0: (3, 4, 1.0)}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_match_brute_force_with_a_hot_group(spark, descending):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 else f"g{i % 11}", float(rnd.randint(0, 400))) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r.k, r.v): (r.n, r.n_before, r.n_all, r.distinct_before)
           for r in R.running_totals(df, ["k"], "v", {"n": F.count(F.lit(1))}, descending, ranges=8).collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    for k, vs in groups.items():
        for v in set(vs):
            earlier = [x for x in vs if (x > v if descending else x < v)]
            assert got[(k, v)] == (vs.count(v), len(earlier), len(vs), len(set(earlier)))


def test_numbered(spark):
    rnd = random.Random(3)
    rows = [(i, float(rnd.randint(0, 20))) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, v double")
    got = [(r.id, r.v) for r in R.numbered(df, [F.desc("v"), F.asc("id")]).orderBy("row_number").collect()]
    assert got == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r[0] for r in R.numbered(df, [F.asc("id")]).orderBy("id").select("row_number").collect()] == list(range(1, 2001))


def test_exact_percentiles_against_numpy(spark):
    rnd = random.Random(5)
    rows = [("a" if i % 3 else "b", rnd.choice([rnd.random() * 100, 50.0])) for i in range(5001)] + [("c", 4.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    points = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {(r.k, r.point): r.value for r in exact_percentiles(df, ["k"], ["v"], points).collect()}
    for k in "abc":
        vs = [v for g, v in rows if g == k]
        for p in points:
            assert got[(k, p)] == pytest.approx(np.percentile(vs, p * 100), abs=1e-9)
    overall = exact_medians(df, [], ["v"]).first()[0]
    assert overall == pytest.approx(median(v for _, v in rows if v is not None))


def test_most_common(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    got = {r.k: r.m for r in df.groupBy("k").agg(most_common("v").alias("m")).collect()}
    assert got == {1: "a", 2: "Unknown"}


def test_lookup_salting_and_uniqueness(spark):
    facts = spark.createDataFrame([(i, i % 3) for i in range(30)], "id int, k int")
    dim = spark.createDataFrame([(0, "x"), (1, "y")], "k int, name string")
    plain = sorted(map(tuple, J.lookup(facts, dim, "k").select("id", "name").collect()))
    salted = sorted(map(tuple, J.lookup(facts, dim, "k", salt=4).select("id", "name").collect()))
    assert plain == salted and len(plain) == 30
    with pytest.raises(ValueError, match="not unique"):
        J.lookup(facts, dim.union(dim), "k", enforce=True)
    with pytest.raises(ValueError, match="unmatched"):
        J.require_match(facts, dim, "k")
    assert J.orphans(facts, dim, "k").count() == 10
    grid = J.spread_over(facts.select("id"), dim.select("name"), buckets=4)
    assert grid.count() == 60 and grid.distinct().count() == 60


def test_keep_one_and_sets(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert sorted(map(tuple, W.keep_one(df, ["k"], [F.col("o")], last=True).collect())) == [("a", 2, "y"), ("b", 1, "z")]
    equal = S.set_equal(df.select("k"), df.select("k")).first()
    assert equal.passed and not S.set_equal(df.select("o"), df.where("o = 1").select("o")).first().passed
    assert S.best_row(df, ["-o", "k"]).first().v == "y"


def test_checks_pass_and_fail(spark):
    good = spark.createDataFrame([(1, 0), (2, 1)], "id int, f int")
    bad = spark.createDataFrame([(1, 0), (1, 5), (None, None)], "id int, f int")
    assert Q.check_pk(good, "id").first().passed
    found = Q.check_pk(bad, "id").first()
    assert (found.missing_keys, found.duplicate_keys, found.passed) == (1, 1, False)
    assert Q.check_grain(bad, ["id"]).first().duplicate_keys == 1
    assert Q.check_domain(good, ["f"], [0, 1]).first().passed and not Q.check_domain(bad, ["f"], [0, 1]).first().passed
    rolled = {r.check_name: r.passed for r in Q.roll_up(Q.check_domain(bad, ["f"], [0, 1])).collect()}
    assert rolled == {"f": False, "all_checks": False}
    with pytest.raises(AssertionError, match="failed checks"):
        Q.enforce(Q.check_domain(bad, ["f"], [0, 1]))
    assert not Q.check_contract(good, ["f", "id"]).first().passed
    assert Q.check_last_unlabelled(bad, ["id"], "f", "f").first().passed is False
    leaks = {r.check_name: r.passed for r in Q.check_leakage(spark, ["a", "future_x", "customer_id"], "y").collect()}
    assert leaks["no_target_feature"] and not leaks["no_future_features"] and not leaks["no_identifier_features"]


def test_matrix_quality_counts_bad_cells(spark):
    df = spark.createDataFrame([(1.0, None), (float("inf"), 2.0), (float("nan"), 1.0)], "a double, b double")
    row = Q.matrix_quality(df, ["a", "b"]).first()
    assert (row.missing_feature_values, row.infinite_feature_values) == (1, 2)


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    row = P.profile(df).first()
    assert (row.row_count, row.duplicate_rows) == (3, 1) and row.missing_cells_pct == pytest.approx(100 * 2 / 6)
    assert [tuple(r) for r in P.missing_pct(df).collect()] == [("b", pytest.approx(200 / 3))]


def test_canonical_label_refuses_unknown_and_colliding_spellings(spark):
    fact = spark.createDataFrame([("ab",), (None,), ("CD",)], "label string")
    good = spark.createDataFrame([("Ab",), ("Cd",)], "label string")
    assert sorted(str(r.label) for r in J.canonical_label(fact, good, "label").collect()) == ["Ab", "Cd", "None"]
    with pytest.raises(ValueError, match="differ by case"):
        J.canonical_label(fact, spark.createDataFrame([("Ab",), ("AB",), ("Cd",)], "label string"), "label")
    with pytest.raises(ValueError, match="unknown labels"):
        J.canonical_label(fact, spark.createDataFrame([("Ab",)], "label string"), "label")
    loose = J.canonical_label(fact, spark.createDataFrame([("Ab",), ("AB",)], "label string"), "label", enforce=False)
    assert sorted(str(r.label) for r in loose.collect()) == ["AB", "None", "None"]
