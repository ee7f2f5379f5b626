"""Rates meet targets far from what is present, or say what remains."""

import warnings

import pytest

from caseloom.llm import mixing


def expected(rows, rates):
    total = sum(r[0] for r in rows)
    k = len(rows[0][1])
    rate = lambda p: max(0.0, 1 + sum(m * x for m, x in zip(rates.multipliers, p, strict=True)))
    assert all(rate(p) >= 0 for _, p in rows)
    return [sum(n * rate(p) * p[j] for n, p in rows) / total for j in range(k)]


@pytest.mark.parametrize("times", [2, 10, 50, 1000])
@pytest.mark.parametrize("sure", [1.0, 0.97])
def test_a_rare_domain_reaches_its_target(spark, times, sure):
    rows = [(100, [sure, 1 - sure])] * 9999 if times == 1000 else [(100, [1.0, 0.0])] * 999
    rows = rows + [(100, [1 - sure, sure])]
    target = times * sum(n * p[1] for n, p in rows) / sum(n for n, _ in rows)
    target = min(target, 0.5 * sure)
    members = spark.createDataFrame(rows, "n_tokens long, p array<double>").coalesce(4)
    rates = mixing.fit_rates(members, [1 - target, target])
    assert rates.met and expected(rows, rates) == pytest.approx([1 - target, target], rel=2.1e-3)
    p = [mixing.F.get("p", mixing.F.lit(j)) for j in range(2)]
    assert members.where(rates.column(p, mixing.F.col("n_tokens")) < 0).isEmpty()


def test_what_no_rates_meet_is_told(spark):
    rows = [(100, [0.9, 0.1]), (50, [0.9, 0.1]), (7, [0.9, 0.1])]
    members = spark.createDataFrame(rows, "n_tokens long, p array<double>").coalesce(1)
    with pytest.warns(UserWarning, match="no rates meet"):
        rates = mixing.fit_rates(members, [0.5, 0.5])
    assert not rates.met and max(map(abs, rates.residual)) > 0.1
    share = expected(rows, rates)
    assert rates.residual == pytest.approx([(s - 0.5) / 0.5 for s in share])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert mixing.fit_rates(members, [0.9, 0.1]).residual == pytest.approx([0, 0], abs=2e-3)
        assert mixing.fit_rates(members.where("false"), [0.9, 0.1]).multipliers == [0.0, 0.0]
