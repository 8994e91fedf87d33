"""Fitted models against plain versions."""

import math

import numpy as np
import pytest

from screenweave.operators import assignment, mixtures, pooled, positions, relaxation


def plain_em(x, tolerance, most, floor=1e-6):
    """Two Gaussians by expectation maximisation, all values at once."""
    x = np.asarray(x, dtype=float)
    c = x.mean()
    z = x - c
    s = z.std()
    w, m, d, last = np.array([0.5, 0.5]), np.array([-s, s]), np.full(2, math.sqrt(s * s + floor)), None
    for k in range(most):
        a = np.log(w) - np.log(d) - (z[:, None] - m) ** 2 / (2 * d**2)
        top = a.max(axis=1, keepdims=True)
        ll = (top[:, 0] + np.log(np.exp(a - top).sum(axis=1))).mean() - 0.5 * math.log(2 * math.pi)
        p = np.exp(a - top)
        p /= p.sum(axis=1, keepdims=True)
        n = p.sum(axis=0)
        w, m = n / len(z), (p * z[:, None]).sum(axis=0) / n
        d = np.sqrt((p * (z[:, None] - m) ** 2).sum(axis=0) / n + floor)
        if last is not None and abs(ll - last) < tolerance:
            break
        last = ll
    order = np.argsort(m)
    return w[order], c + m[order], d[order], k + 1


def test_mixtures_are_a_plain_em(spark):
    r = np.random.default_rng(3)
    groups = {
        (1, "A"): np.concatenate([r.normal(100, 5, 400), r.normal(160, 20, 200)]), (1, "C"): np.round(np.concatenate([r.normal(10, 1, 300), r.normal(14, 1, 900)])),
        (2, "A"): r.normal(0, 1, 500), (None, "G"): 1e9 + np.concatenate([r.normal(0, 1, 200), r.normal(9, 2, 200)]),
    }
    rows = [(*k, float(v)) for k, x in groups.items() for v in x] + [(1, "A", None), (1, "A", float("nan")), (1, "A", float("inf")), (3, "T", None), (4, "T", 7.0), (4, "T", 7.0)]
    got = {(x.cycle, x.channel): x for x in mixtures.fit(spark.createDataFrame(rows, "cycle int, channel string, v double"), ["cycle", "channel"], "v", 1e-5, 40).collect()}
    assert set(got) == {*groups, (4, "T")}
    for k, x in groups.items():
        w, m, d, rounds = plain_em(x, 1e-5, 40)
        f = got[k]
        assert f.n == len(x) and f.rounds == rounds and f.converged == (rounds < 40)
        assert np.allclose([f.low_weight, f.high_weight, f.low_sd, f.high_sd], [*w, *d], rtol=1e-6)
        assert np.allclose([f.low_mean, f.high_mean], m, rtol=1e-6, atol=1e-6)
    one = got[(4, "T")]
    assert one.low_mean == one.high_mean == 7.0 and one.converged


def test_mixture_tables(spark):
    f = spark.createDataFrame([(1, 1000, 0.75, 10.0, 2.0, 0.25, 30.0, 4.0), (2, 10, 0.5, 5.0, 0.0, 0.5, 5.0, 0.0)], "k int, n long, low_weight double, low_mean double, low_sd double, high_weight double, high_mean double, high_sd double")
    rows = {(x.k, x.type): x for x in mixtures.signal_table(f, ["k"]).collect()}
    assert rows[(1, "Signal")]["count"] == 250 and rows[(1, "Signal")].median_top == pytest.approx(30 + 1.28 * 4) and rows[(1, "Background")]["count"] == 750 and rows[(1, "Background")].median_top is None
    s = {x.k: x for x in mixtures.separation(f, ["k"]).collect()}
    assert s[1].snr == pytest.approx(10) and s[1].z_prime == pytest.approx(1 - 18 / 20) and s[2].snr == 0


def grid_edges(h, w, seed, bad=0.0):
    r = np.random.default_rng(seed)
    out = []
    for i in range(h):
        for j in range(w):
            for di, dj in ((0, 1), (1, 0)):
                if i + di < h and j + dj < w:
                    shift = np.array([90.0 * di, 90.0 * dj]) + r.normal(0, 1, 2) + (r.uniform(30, 60, 2) if r.uniform() < bad else 0)
                    out.append((i * w + j, (i + di) * w + j + dj, *map(float, shift), float(r.uniform(0.5, 2))))
    return out


def least_squares(edges, n, weights=None):
    """numpy's solution, the least tile at 0, 0."""
    w = np.sqrt([e[4] for e in edges] if weights is None else weights)
    m, t = np.zeros((len(edges), n)), np.array([e[2:4] for e in edges])
    for k, (a, b, *_) in enumerate(edges):
        m[k, b], m[k, a] = 1, -1
    p = np.linalg.lstsq(m * w[:, None], t * w[:, None], rcond=None)[0]
    return p - p[0]


SHIFTS = "a long, b long, dy double, dx double, weight double"


def test_positions_of_a_thousand_tiles(spark):
    edges = grid_edges(25, 40, 1)
    more = [(a + 5000, b + 5000, *rest) for a, b, *rest in grid_edges(3, 3, 2)] + [(9000, 9000, 1.0, 1.0, 1.0), (9001, None, 1.0, 1.0, 1.0), (9001, 9002, 1.0, 1.0, 0.0)]
    got = positions.solved(spark.createDataFrame(edges + more, SHIFTS)).collect()
    assert len(got) == 1009 and {r.component for r in got} == {0, 5000}
    want = least_squares(edges, 1000)
    assert all(np.allclose([r.y, r.x], want[r.tile], atol=1e-5) for r in got if r.component == 0)


def test_bad_edges_are_weighed_down(spark):
    edges = grid_edges(12, 12, 3, bad=0.05)
    df = spark.createDataFrame(edges, SHIFTS)
    true = np.array([[90.0 * (k // 12), 90.0 * (k % 12)] for k in range(144)])
    off = lambda places: np.mean([np.hypot(r.y - true[r.tile][0], r.x - true[r.tile][1]) for r in places])
    robust = positions.solved(df, 3.0)
    assert off(robust.collect()) < 0.5 * off(positions.solved(df).collect())
    assert positions.residuals(df, robust).where("off > 20").count() > 3


def test_large_components_by_joins(spark, monkeypatch):
    edges = grid_edges(3, 3, 4)
    df = spark.createDataFrame(edges, SHIFTS)
    small = {r.tile: (r.y, r.x) for r in positions.solved(df, 2.0, 1).collect()}
    monkeypatch.setattr(positions, "WHOLE", 3)
    large = {r.tile: (r.y, r.x) for r in positions.solved(df, 2.0, 1).collect()}
    assert set(small) == set(large) and all(np.allclose(small[k], large[k], atol=1e-6) for k in small)


def best_sum(rows):
    """The largest sum of gains, by trying all."""

    def go(k, used):
        if k == len(sources):
            return 0.0
        return max([go(k + 1, used), *(g + go(k + 1, used | {t}) for t, g in by[sources[k]] if t not in used)])

    by = {}
    for s, t, c in rows:
        if 1 - c > 0:
            by.setdefault(s, []).append((t, 1 - c))
    sources = sorted(by)
    return go(0, frozenset())


def test_assignment_is_the_best(spark, monkeypatch):
    r = np.random.default_rng(6)
    groups = [[(100 * g + int(s), 100 * g + int(t), float(np.round(c, 2))) for s, t, c in zip(r.integers(0, 5, 12), r.integers(0, 5, 12), r.uniform(0, 1.2, 12))] for g in range(12)]
    rows = [x for g in groups for x in g]
    df = spark.createDataFrame([*rows, *rows[:3], (None, 1, 0.1), (1, None, 0.1), (2, 3, None)], "src long, dst long, cost double")
    want = [best_sum(list({(s, t): c for s, t, c in sorted(g, reverse=True)}.items()) and [(s, t, c) for (s, t), c in {(s, t): c for s, t, c in sorted(g, reverse=True)}.items()]) for g in groups]
    got = assignment.linked(df).collect()
    assert len({x.src for x in got}) == len({x.dst for x in got}) == len(got)
    for g, w in enumerate(want):
        assert sum(x.gain for x in got if x.src // 100 == g) == pytest.approx(w, abs=5e-3)
    for g in range(200):
        n = r.integers(1, 13)
        s, t = (np.unique(x, return_inverse=True)[1] for x in np.unique(r.integers(0, 5, (2, n)), axis=1))
        gain = np.round(r.uniform(0, 1, len(s)), 2) + 0.01
        want_ = best_sum(list(zip(s.tolist(), t.tolist(), (1 - gain).tolist())))
        assert gain[assignment.exact(s, t, gain)].sum() == pytest.approx(want_)
        order = np.lexsort((t, s))
        assert gain[order][assignment.auction(s[order], t[order], gain[order], 1e-4)].sum() == pytest.approx(want_, abs=1e-3)
    monkeypatch.setattr(assignment, "DENSE", 0)
    assert sum(x.gain for x in assignment.linked(df).collect()) == pytest.approx(sum(want), abs=5e-3)
    monkeypatch.setattr(assignment, "WHOLE", 6)
    few = spark.createDataFrame(groups[0] + groups[1], "src long, dst long, cost double")
    large = assignment.linked(few, epsilon=0.01).collect()
    assert sum(x.gain for x in large) == pytest.approx(want[0] + want[1], abs=0.1)
    assert not assignment.linked(df.limit(0)).collect()


def test_relaxation_finds_a_planted_scene(spark):
    r = np.random.default_rng(8)
    n, angle = 400, 0.01
    p = r.uniform(0, 900, (n, 2))
    turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
    q = p @ turn.T + np.array([6.0, -5.0]) + r.normal(0, 0.3, (n, 2))
    lost = r.uniform(size=n) < 0.3
    q[lost] = r.uniform(0, 900, (lost.sum(), 2))
    side = lambda v: spark.createDataFrame([("w", k, float(y), float(x)) for k, (y, x) in enumerate(v)], "well string, id long, y double, x double")
    got = [(x.id_a, x.id_b) for x in relaxation.matched(side(p), side(q), 40.0, 150.0, k=8, tolerance=3.0, keys=["well"]).collect()]
    right = sum(a == b and not lost[a] for a, b in got)
    assert right / len(got) > 0.95 and right / (~lost).sum() > 0.95


def plain_effects(cells, used, downsample, least):
    """The pooled effects from all rows at once."""
    x = {e: np.array([c[4] for c in cells if c[0] == e and c[3]]) for e in {c[0] for c in cells}}
    unit = lambda v: v / np.where((n := np.linalg.norm(v, axis=-1, keepdims=True)) == 0, 1, n)
    stats = {e: (v.mean(axis=0), np.where((s := v.std(axis=0, ddof=1)) == 0, 1, s), unit(unit(v).mean(axis=0)), len(v)) for e, v in x.items() if len(v) > 1}
    g = unit(sum(s[2] * s[3] for s in stats.values()) / sum(s[3] for s in stats.values()))
    by = {}
    for e, guide, m, control, v in cells:
        if not control and e in stats:
            b = min(int(np.searchsorted(used[1:-1], m, side="right")), len(used) - 2)
            by.setdefault(guide, {}).setdefault(b, {}).setdefault(e, []).append(np.array(v))
    out = {}
    for guide, bins in by.items():
        k = min(sum(map(len, parts.values())) for parts in bins.values())
        if len(bins) < (len(used) - 1 if downsample else 2) or downsample and k < least:
            continue
        for b, parts in bins.items():
            n = sum(map(len, parts.values()))
            take = min(n, k) if downsample else n
            share = {e: take * len(v) / n for e, v in parts.items()}
            chosen = {e: int(s + 1e-9) for e, s in share.items()}
            for e in sorted(share, key=lambda e: (-(share[e] - chosen[e]), e))[: take - sum(chosen.values())]:
                chosen[e] += 1
            z = sum(((np.array(v) - stats[e][0]) / stats[e][1]).sum(axis=0) * chosen[e] / len(v) for e, v in parts.items()) / take
            u = unit(sum(unit(np.array(v)).sum(axis=0) * chosen[e] / len(v) for e, v in parts.items()))
            out[(guide, b)] = (n, take, np.sqrt((z**2).mean()), 1 - u @ g)
    return out


@pytest.mark.parametrize("strategy,scale", [("fixed", 1), ("integer", 17)])
def test_two_passes_equal_one(spark, tmp_path, strategy, scale):
    r = np.random.default_rng(9)
    cells = [(int(e), f"g{k % 5}", float(np.floor(m * scale) if scale > 1 else np.round(m, 1)), bool(k % 7 == 0), [float(v) for v in r.normal(k % 5, 1, 4)]) for k, (e, m) in enumerate(zip(r.integers(0, 3, 400), r.uniform(0, 1, 400)))]
    frame = lambda rows: spark.createDataFrame([(e, g, g.upper(), m, c, v) for e, g, m, c, v in rows], "experiment long, guide string, gene string, m double, control boolean, v array<double>")
    paths = {n: str(tmp_path / n) for n in ("counts", "partials", "controls")}

    def add(rows):
        df = frame(rows)
        pooled.stored(pooled.metric_counts(df, "m"), paths["counts"])
        pooled.stored(pooled.partials(df, "m", "v", strategy, 4), paths["partials"])
        pooled.stored(pooled.controls(df, "v"), paths["controls"])

    add([c for c in cells if c[0] < 2])
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "partials").glob("experiment=[01]/*.parquet")}
    add([c for c in cells if c[0] == 2])
    assert before and {f: f.stat().st_mtime_ns for f in (tmp_path / "partials").glob("experiment=[01]/*.parquet")} == before
    counts, partial, control = (spark.read.parquet(p) for p in paths.values())
    used = pooled.edges(counts, strategy, 4)
    if strategy == "fixed":
        assert used == [0.0, 0.25, 0.5, 0.75, 1.0]
    else:
        v = np.array([c[2] for c in cells if not c[3]])
        width = max(1, int(np.ceil(max(1, int(np.ceil(np.percentile(v, 95)))) / 4)))
        assert used == [float(k * width) for k in range(len(used))] and used[-1] >= v.max()
    for downsample in (False, True):
        got = {(x.guide, x.bin): (x.n, x.taken, x.cohens_d, x.cosine_distance) for x in pooled.effects(partial, control, used, strategy, 4, 3, downsample).collect()}
        want = plain_effects(cells, used, downsample, 3)
        assert set(got) == set(want) and len(got) > 8
        assert all(got[k][:2] == want[k][:2] and np.allclose(got[k][2:], want[k][2:], atol=1e-9) for k in want)
