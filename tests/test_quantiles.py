"""Exact quantiles of small and of hot groups."""

import random

import numpy as np
import pytest

from tenderspark.operators import prices as P
from tenderspark.operators import quantiles as Q


def values(seed):
    rng = random.Random(seed)
    rows = [("hot", rng.lognormvariate(3, 4)) for _ in range(9000)]  # a third of all rows, all values different, heavy tail
    rows += [("ties", float(rng.choice([1, 1, 1, 2, 5]))) for _ in range(5000)]
    rows += [(None, -rng.random() * 1e-300) for _ in range(4001)]
    rows += [(f"g{rng.randint(0, 200)}", rng.choice([None, rng.random()])) for _ in range(9000)]
    rows += [("one", 7.0), ("none", None), ("two", 1.0), ("two", 2.0), ("top", 1e308), ("hot", None), ("hot", -1e308)]
    return rows


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_are_exact(spark, accuracy):
    rows = values(1)
    df = spark.createDataFrame(rows, "code string, price double")
    got = {r.code: r.q for r in Q.exact_quantiles(df, ["code"], "price", [0.25, 0.75, 0.5, 0.0, 1.0], 3000, accuracy).collect()}
    by = {}
    for code, v in rows:
        by.setdefault(code, []).append(v)
    assert set(got) == set(by)
    for code, vs in by.items():
        vs = [v for v in vs if v is not None]
        if vs:
            assert np.allclose(got[code], np.quantile(vs, [0.25, 0.75, 0.5, 0.0, 1.0]), rtol=1e-12, atol=0), code
        else:
            assert got[code] is None or got[code] == [None] * 5


def test_a_bracket_that_misses_is_widened(spark):
    df = spark.createDataFrame([("a", float(i), 100) for i in range(100)], "code string, _v double, _n long")
    cuts = spark.createDataFrame([("a", 0, 24.75, 60.0, 70.0, 0.0, 99.0), ("a", 1, 74.25, 70.0, 80.0, 0.0, 99.0)], "code string, i int, at double, lo double, hi double, _min double, _max double")
    got = {r.i: (r.lo, r.hi, r.below) for r in Q._checked(df, cuts, ["code"]).collect()}
    assert got == {0: (0.0, 99.0, 0), 1: (70.0, 80.0, 70)}


def test_flags_do_not_depend_on_how_large_a_group_counts_as_hot(spark):
    df = spark.createDataFrame(values(2), "code string, price double")
    flags = lambda hot: sorted(map(tuple, P.price_flags(df, ["code"], "price", 0.5, hot_rows=hot).collect()), key=repr)
    cold = flags(10**9)
    assert flags(3000) == cold and len(cold) == len(values(2))
    assert sum(r[2] for r in cold) > 1000
