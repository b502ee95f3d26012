"""Sums of doubles: exact against fractions, the same bits however the rows are dealt."""

import math
import random
from fractions import Fraction

import pytest

from sheaf.operators import exactsums, folds

PARTS = (1, 3, 8)


def wild(seed, n=400):
    rng = random.Random(seed)
    return [rng.choice((-1, 1)) * rng.random() * 2.0 ** rng.randint(-60, 60) for _ in range(n)]


def bits(df):
    return {tuple(v.hex() if isinstance(v, float) else v for v in row) for row in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_totals_dots_and_weights_are_exact_and_keep_their_bits(frame, seed):
    a, b = wild(seed), wild(seed + 100)
    rows = [(i % 3, i, x, y) for i, (x, y) in enumerate(zip(a, b))]
    seen = {"totals": set(), "dot": set(), "weighted": set()}
    for parts in PARTS:
        df = frame(rows, "k int, i int, a double, b double", parts)
        seen["totals"].add(frozenset(bits(exactsums.exact_totals(df, {"x": "a", "y": "b"}, ["k"]))))
        seen["dot"].add(frozenset(bits(exactsums.exact_dot(df, "a", "b", ["k"]))))
        seen["weighted"].add(frozenset(bits(folds.position_weighted_sum(df, "a", ["i"], ["k"]))))
    assert all(len(results) == 1 for results in seen.values())
    for k in range(3):
        own = [(Fraction(x), Fraction(y)) for key, _, x, y in rows if key == k]
        expected = {
            "totals": (k, float(sum(x for x, _ in own)).hex(), float(sum(y for _, y in own)).hex()),
            "dot": (k, float(sum(x * y for x, y in own)).hex()),
            "weighted": (k, float(sum(x * (i + 1) for i, (x, _) in enumerate(own))).hex()),
        }
        for name, row in expected.items():
            assert row in next(iter(seen[name])), name


def test_cancelling_terms_leave_the_small_one(frame):
    df = frame([(1e200, 1e100), (1.0, 1e-300), (-1e200, 1e100), (3.0, 0.5)], "a double, b double")
    assert exactsums.exact_dot(df, "a", "b").first().dot == 1.5
    assert exactsums.exact_totals(df, {"x": "a"}).first().x == 4.0
    large = frame([(1e308, 1.0), (1e308, -1.0), (5e-324, 1.0)], "a double, b double")
    assert exactsums.exact_dot(large, "a", "b").first().dot == 5e-324


def test_missing_empty_and_endless_values(frame):
    df = frame([(1, None, 2.0), (2, math.inf, 1.0), (2, 1.0, 1.0), (3, math.nan, 1.0), (4, 0.0, -0.0)], "k int, a double, b double")
    totals = {r.k: r.x for r in exactsums.exact_totals(df, {"x": "a"}, ["k"]).collect()}
    assert totals[1] == 0.0 and totals[2] == math.inf and math.isnan(totals[3]) and totals[4] == 0.0
    dots = {r.k: r.dot for r in exactsums.exact_dot(df, "a", "b", ["k"]).collect()}
    assert dots[1] == 0.0 and dots[2] == math.inf and math.isnan(dots[3]) and dots[4] == 0.0
    none = df.where("k > 9")
    assert exactsums.exact_totals(none, {"x": "a", "y": "b"}).first().asDict() == {"x": 0.0, "y": 0.0}
    assert exactsums.exact_dot(none, "a", "b").first().dot == 0.0
    assert exactsums.exact_totals(none, {"x": "a"}, ["k"]).collect() == []
    weighted = folds.position_weighted_sum(df, "a", ["a"], ["k"])
    assert {r.k for r in weighted.collect()} == {1, 2, 3, 4}


def test_folds_over_doubles_keep_their_bits(frame):
    values = wild(7, 300)
    rows = [(x, abs(x), i) for i, x in enumerate(values)]
    results = set()
    for parts in PARTS:
        df = frame(rows, "a double, p double, n int", parts)
        results.add(
            (
                folds.total(df, "a").first().total.hex(),
                folds.log_total(df, "p").first().log_total.hex(),
                folds.pair_total(df, "a", "n").first().first.hex(),
                str(folds.pair_total(df, "a", "n").first().second),
                folds.total_and_max(df, "a", "p").first().total.hex(),
                folds.total_and_max(df, "a", "p").first().max,
            )
        )
    assert len(results) == 1
    found = results.pop()
    exact = float(sum(map(Fraction, values))).hex()
    assert found[0] == found[2] == found[4] == exact
    assert found[3] == str(sum(range(300))) and found[5] == max(map(abs, values))


def test_more_stretches_than_one(frame, monkeypatch):
    monkeypatch.setattr(folds, "STRETCH_BITS", 2)
    values = wild(3, 120)
    for parts in PARTS:
        df = frame([(i, x) for i, x in enumerate(values)], "i int, a double", parts)
        expected = float(sum(Fraction(x) * (i + 1) for i, x in enumerate(values)))
        assert folds.position_weighted_sum(df, "a", ["i"], unique_order=True).first().weighted == expected
