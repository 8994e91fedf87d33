"""Relaxed matches by task and by tables: the same rows."""

import numpy as np
import pytest

from screenweave.operators import relaxation


def scene(spark):
    """Two sides of three planes: moved points, some lost, many at one place, ties on a grid, rows without place or key."""
    r = np.random.default_rng(4)
    a, b = [], []
    for well, n in (("u", 120), ("v", 60), (None, 30)):
        p = r.uniform(0, 300, (n, 2)).round(1)
        p[: n // 6] = p[0]
        q = p + [4.0, -3.0] + r.normal(0, 0.3, (n, 2)).round(1)
        lost = r.uniform(size=n) < 0.2
        q[lost] += r.uniform(0, 30, (lost.sum(), 2))
        a += [(well, k, float(y), float(x)) for k, (y, x) in enumerate(p)]
        b += [(well, k + 1000, float(y), float(x)) for k, (y, x) in enumerate(q)]
    grid = [(float(y * 10), float(x * 10)) for y in range(7) for x in range(7)]
    a += [("g", k, y, x) for k, (y, x) in enumerate(grid)] + [("u", 901, None, 1.0), ("u", 902, float("nan"), 1.0), ("u", 903, float("inf"), 1.0), ("alone", 1, 0.0, 0.0)]
    b += [("g", k, y, x + 5) for k, (y, x) in enumerate(grid)] + [("u", 1901, 1.0, None)]
    return [spark.createDataFrame(x, "well string, id long, y double, x double").repartition(3) for x in (a, b)]


def rows(df):
    return sorted((*x[:-2], round(x.distance, 9), round(x.score, 9)) for x in df.collect())


def test_planes_in_one_task_are_matched_as_by_tables(spark, monkeypatch):
    sides, how = scene(spark), {"radius": 12.0, "reach": 60.0, "k": 6, "tolerance": 2.0, "least": 0.3, "keys": ["well"]}
    by_tables, called = relaxation.by_tables, []
    monkeypatch.setattr(relaxation, "by_tables", lambda *x: called.append(x[0].select("well").distinct().count()) or by_tables(*x))
    got = rows(relaxation.matched(*sides, **how))
    assert not called  # no joins in rounds for small planes
    assert {x[0] for x in got} == {"u", "v", "g"} and len(got) > 100
    with monkeypatch.context() as m:
        m.setattr(relaxation, "WHOLE", 0)
        assert rows(relaxation.matched(*sides, **how)) == got and called == [4]
    with monkeypatch.context() as m:  # one large plane, one with too many pairs for a task
        m.setattr(relaxation, "WHOLE", 200)
        m.setattr(relaxation, "WORK", 8000)
        assert rows(relaxation.matched(*sides, **how)) == got and 0 < called[1] < 4


def test_points_of_one_plane_need_no_keys(spark):
    sides = [x.where("well = 'v'") for x in scene(spark)]
    got = [rows(relaxation.matched(*[x.drop(*drop) for x in sides], 12.0, 60.0, 6, 2.0, keys=keys)) for drop, keys in ((["well"], []), ([], ["well"]))]
    assert got[0] == [x[1:] for x in got[1]] and got[0]
    assert relaxation.matched(*[x.limit(0) for x in sides], 12.0, 60.0, keys=["well"]).count() == 0


def test_a_task_stops_at_dense_planes():
    p = np.zeros((2, 4000))
    with pytest.raises(relaxation.Dense):
        relaxation._solved(p, p, 1_000_000, 12.0, 60.0, 6, 2.0, 6, 0.5, 0.05)
