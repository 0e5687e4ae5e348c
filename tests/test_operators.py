"""Hand-worked cases, invariants and brute-force comparisons on small tables."""

from __future__ import annotations

import datetime
import hashlib
import itertools
import math
import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellcast.functions import scalar
from cellcast.functions.vectorized import _bracketed_median, gamma_ppf, log_gamma, pair_slope_medians, pearson3_exceedance, pearson3_quantile, regularized_gamma
from cellcast.operators import compare, decadal, delivery, events, filters, graph, grids, portfolio, ranks, recompute, rings, spatial, tiles
from cellcast.operators.ranking import cumulative_counts, exact_quantiles
from cellcast.operators.tiles import Tiling
from cellcast.plans import hazards
from cellcast.plans.layer import LayerSpec, build_layer
from cellcast.plans.models import kendall, kendall_p, pearson3_parameters, shifted_periods
from cellcast.sources import sinks
from cellcast.streaming import incremental

ANNUAL = "scenario STRING, model STRING, member STRING, cell_id BIGINT, year INT, value DOUBLE"


def annual(spark, series, scenario="ssp585", cell=1, start=2020):
    """One row per member and year from {member: [values]}; None is missing."""
    rows = [
        (scenario, m.split("_")[0], m, cell, start + i, None if v is None else float(v))
        for m, values in series.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, ANNUAL)


def one(df, *cols):
    rows = df.collect()
    assert len(rows) == 1
    return tuple(rows[0][c] for c in cols)


def test_median_and_quartiles_of_ten_values(spark):
    df = decadal.pooled_decadal_stat(annual(spark, {"a_x": range(10)}), [2020])
    assert one(df, "median", "lower_ci", "upper_ci") == (4.5, 2.25, 6.75)


def test_mean_branch_uses_population_sd(spark):
    df = decadal.pooled_decadal_stat(annual(spark, {"a_x": [1] * 6 + [0] * 4}), [2020], central="mean")
    mean, lo, hi = one(df, "median", "lower_ci", "upper_ci")
    sd = math.sqrt(0.24)
    assert (mean, lo, hi) == pytest.approx((0.6, 0.6 - sd, 0.6 + sd))


def test_members_and_years_are_pooled_jointly(spark):
    df = decadal.pooled_decadal_stat(annual(spark, {"a_x": [0] * 10, "b_x": [0] * 10, "c_x": [12] * 10}), [2020])
    assert one(df, "median", "upper_ci") == (0.0, 12.0)


def test_missing_cells_stay_missing(spark):
    df = decadal.pooled_decadal_stat(annual(spark, {"a_x": [None] * 10}), [2020])
    assert one(df, "median", "lower_ci") == (None, None)
    depth = decadal.ensemble_depth(annual(spark, {"a_x": [None] * 10}), [2020])
    assert one(depth, "n_members", "n_models") == (None, None)


def test_slopes_follow_a_line_and_the_baseline_has_none(spark):
    series = {m: [0.5 * t + k for t in range(20)] for k, m in enumerate(("a_x", "b_x", "c_x"))}
    df = decadal.slopes(annual(spark, series), [2020, 2030], 2020)
    assert one(df, "decade", "ols_slope", "sen_slope") == (2030, pytest.approx(0.5), pytest.approx(0.5))


def test_sen_is_zero_on_zero_inflated_series_while_ols_is_not(spark):
    df = decadal.slopes(annual(spark, {"a_x": [0] * 16 + [3, 4, 5, 6]}), [2020, 2030], 2020)
    ols, sen = one(df, "ols_slope", "sen_slope")
    assert sen == 0.0 and ols > 0.1


def test_constant_series_has_exactly_zero_slopes_and_two_points_have_none(spark):
    df = decadal.slopes(annual(spark, {"a_x": [3] * 20}), [2020, 2030], 2020)
    assert one(df, "ols_slope", "sen_slope") == (0.0, 0.0)
    df = decadal.slopes(annual(spark, {"a_x": [1, 2] + [None] * 18}), [2020, 2030], 2020)
    assert one(df, "ols_slope", "sen_slope") == (None, None)


def test_pair_slope_medians_equal_brute_force_at_every_end():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 301):
        x = np.sort(rng.integers(0, 9, n).astype(float))
        y = np.round(rng.normal(size=(3, n)), 1)
        y[1] = 4.25
        ends = np.array([-1.0, 2.0, 5.0, 20.0])
        got = pair_slope_medians(x, y, ends)
        for row, values in zip(got, y):
            for k, end in enumerate(ends):
                pairs = [(values[j] - values[i]) / (x[j] - x[i]) for i, j in itertools.combinations(range(n), 2) if x[i] != x[j] and x[j] <= end]
                assert np.isnan(row[k]) if not pairs else row[k] == pytest.approx(np.median(pairs), abs=1e-12)


def test_bracketed_median_is_exact_on_ties_gaps_and_odd_and_even_lengths():
    rng = np.random.default_rng(8)
    for x in (rng.normal(size=40_001), rng.integers(0, 3, 40_000).astype(float), np.repeat([1.0, 5.0], 20_000), np.append(np.zeros(30_000), rng.normal(size=30_001)), np.arange(50_000.0)):
        assert _bracketed_median(x.copy()) == np.median(x)


def test_slopes_of_many_decades_come_from_one_shuffle(spark):
    rng = np.random.default_rng(5)
    rows = [("s", m, f"m{m}", c, 2000 + t, None if rng.random() < 0.2 else float(np.round(rng.normal(), 2)) if c else 7.5) for c in range(6) for m in "abc" for t in range(40) if c != 5 or t >= 25]
    df = spark.createDataFrame(rows, "scenario STRING, member STRING, model STRING, cell_id BIGINT, year INT, value DOUBLE")
    decades = [2000, 2010, 2020, 2030]
    got = {(r["cell_id"], r["decade"]): r for r in decadal.slopes(df, decades, 2000).collect()}
    assert set(got) == {(c, d) for c in range(6) for d in decades[1:] if c != 5 or d >= 2020}
    alone = {name: {(r["cell_id"], r["decade"]): r[name] for r in f(df, decades, 2000).collect()} for name, f in (("ols_slope", decadal.ols_slope), ("sen_slope", decadal.sen_slope))}
    for (c, d), r in got.items():
        pts = [(y, v) for _, _, _, cell, y, v in rows if cell == c and v is not None and y <= d + 9]
        x, y = (np.array(z, float) for z in zip(*pts))
        ols = 0.0 if c == 0 else np.polyfit(x, y, 1)[0]
        sen = np.median([(q[1] - p[1]) / (q[0] - p[0]) for p, q in itertools.combinations(pts, 2) if p[0] != q[0]])
        assert r["ols_slope"] == pytest.approx(ols, abs=1e-9) and r["sen_slope"] == pytest.approx(sen, abs=1e-12)
        assert r["ols_slope"] == pytest.approx(alone["ols_slope"][c, d], abs=1e-12) and r["sen_slope"] == alone["sen_slope"][c, d]
    plan = decadal.slopes(df, decades, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_baseline_modes_differ(spark):
    a = annual(spark, {"a_x": [0] * 10}, "ssp126").unionByName(annual(spark, {"a_x": [10] * 10}, "ssp585"))
    a = a.unionByName(annual(spark, {"b_x": [9] * 10}, "ssp585"))
    pooled = one(decadal.shared_baseline(a, 2020, "pool_all"), "median")
    first = one(decadal.shared_baseline(a, 2020, "member_mean_first"), "median")
    assert pooled == (9.0,) and first == (7.0,)
    with pytest.raises(ValueError):
        decadal.shared_baseline(a, 2020, "other")


def test_boolean_field_is_judged_on_every_value(spark):
    flag = lambda vs: one(filters.is_boolean_field(annual(spark, {"a_x": vs})), "is_boolean")[0]
    assert flag([0, 1, None, 1]) is True
    assert flag([0, 1, 0.5]) is False
    assert flag([None, None]) is False


def test_structural_zeros_mask_only_members_that_never_had_any(spark):
    a = annual(spark, {"a_x": [0, 0, 2], "b_x": [0, 0, 0]})
    got = {(r["member"], r["year"]): r["value"] for r in filters.mask_structural_zeros(a).collect()}
    assert got[("a_x", 2020)] == 0.0 and got[("b_x", 2020)] is None


def test_exact_quantiles_and_counts_equal_brute_force_on_a_skewed_key(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", float(rng.choice([0, 0, 0, rng.randrange(400)]))) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(16)
    qs = [0.0, 0.05, 0.5, 0.93, 1.0]
    got = {(r["k"], r["q"]): r["quantile"] for r in exact_quantiles(df, "v", qs, ["k"]).collect()}
    for k in {r[0] for r in rows}:
        values = [v for kk, v in rows if kk == k]
        for q in qs:
            assert got[(k, q)] == pytest.approx(np.quantile(values, q))
    everything = [v for _, v in rows]
    for r in cumulative_counts(df, "v", ranges=37).collect():
        assert r["n_below"] == sum(v < r["v"] for v in everything)
        assert r["n_upto"] == sum(v <= r["v"] for v in everything)


def test_two_tier_rank_puts_zero_at_one_and_the_top_at_hundred(spark):
    base = spark.createDataFrame([(i, float(max(0, i - 50))) for i in range(100)], "cell_id BIGINT, median DOUBLE")
    got = {r["median"]: r["percentile"] for r in ranks.two_tier_percentile(base, base).collect()}
    assert got[0.0] == 1.0 and got[49.0] == 100.0 and 2 <= got[1.0] < 5
    up = {r["median"]: r["percentile"] for r in ranks.two_tier_percentile(base, base, higher_is_better=True).collect()}
    assert up[0.0] == 100.0 and up[49.0] == 1.0


def test_lone_occupied_cell_ranks_as_declared(spark):
    r = spark.createDataFrame([(1, 2.0, 3), (2, 0.0, 0)], "cell_id BIGINT, rate DOUBLE, n_events INT")
    for alone in (100.0, 2.0):
        got = {x["cell_id"]: x["percentile"] for x in ranks.observed_rate_rank(r, alone=alone).collect()}
        assert got == {1: alone, 2: 1.0}


def test_layer_does_not_depend_on_order_or_partitions(spark):
    rng = random.Random(1)
    parts = [annual(spark, {m: [rng.choice([0, rng.random()]) for _ in range(20)] for m in ("a_x", "b_y", "b_z")}, s, c) for s in ("ssp126", "ssp585") for c in range(6)]
    a = parts[0]
    for p in parts[1:]:
        a = a.unionByName(p)
    spec = LayerSpec(decades=[2020, 2030], ci_floor=0.0)
    rows = lambda d: sorted(tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v) for v in r) for r in build_layer(d, spec).collect())
    first = rows(a)
    assert first == rows(a.orderBy(F.rand(2)).repartition(13))
    baseline = {}
    for r in build_layer(a, spec).where("decade = 2020").collect():
        baseline.setdefault(r["cell_id"], set()).add((r["median"], r["percentile"]))
        assert r["ols_slope"] is None and r["sen_slope"] is None
    assert all(len(v) == 1 for v in baseline.values())


def test_gamma_quantiles_invert_the_distribution():
    a = np.array([0.5, 1.0, 3.5, 40.0, 900.5])
    for q in (0.25, 0.5, 0.75):
        x = gamma_ppf(q, a)
        assert regularized_gamma(a, x) == pytest.approx(np.full(5, q), abs=1e-10)
    assert gamma_ppf(0.5, np.array([1.0]))[0] == pytest.approx(math.log(2))


def test_poisson_interval_is_ordered_and_positive_at_zero_count(spark):
    cells = spark.createDataFrame([(i, k, 2.0) for i, k in enumerate((0, 1, 7))], "cell_id INT, k INT, t DOUBLE")
    for r in events.poisson_rate_interval(cells, "k", "t").collect():
        assert 0 < r["lower_ci"] < r["median"] < r["upper_ci"]
    mle = {r["k"]: r for r in events.poisson_rate_interval(cells, "k", "t", "mle").collect()}
    assert mle[0]["median"] == 0.0 == mle[0]["lower_ci"] and mle[7]["median"] == 3.5


def clip_area(ring: np.ndarray, west: float, south: float, east: float, north: float) -> float:
    """Area of a polygon ring cut to a rectangle, one half-plane at a time."""
    pts = ring
    for axis, bound, keep_above in ((0, west, True), (0, east, False), (1, south, True), (1, north, False)):
        if len(pts) == 0:
            return 0.0
        side = (pts[:, axis] >= bound) if keep_above else (pts[:, axis] <= bound)
        out = []
        for k in range(len(pts)):
            p, q = pts[k - 1], pts[k]
            if side[k - 1] != side[k]:
                t = (bound - p[axis]) / (q[axis] - p[axis])
                out.append(p + t * (q - p))
            if side[k]:
                out.append(q)
        pts = np.array(out)
    if len(pts) < 3:
        return 0.0
    x, y = pts[:, 0], pts[:, 1]
    return 0.5 * abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))))


def test_clip_area_of_triangle():
    tri = np.array([[0, 0], [2, 0], [0, 2.0]])
    assert clip_area(tri, 0, 0, 1, 1) == pytest.approx(1.0)
    assert clip_area(tri, 5, 5, 6, 6) == 0.0


def test_uniform_elevations_expose_linearly(spark):
    rows = [(1, i * 0.05 + 0.025, True, True) for i in range(200)]
    px = spark.createDataFrame(rows, "cell_id BIGINT, elevation DOUBLE, wide BOOLEAN, near BOOLEAN")
    hist, totals = events.hypsometry(px)
    levels = spark.createDataFrame([(1, x) for x in (0.0, 2.5, 5.0)], "cell_id BIGINT, level DOUBLE")
    got = {r["level"]: r for r in events.coastal_exposure(hist, totals, events.calibration_curve(hist), levels).collect()}
    assert got[0.0]["exposed"] == 0.0 and got[2.5]["exposed"] == pytest.approx(0.25) and got[5.0]["exposed"] == pytest.approx(0.5)
    assert got[0.0]["percentile"] < got[2.5]["percentile"] < got[5.0]["percentile"]


def test_closed_basin_is_never_exposed_but_counts_as_land(spark):
    px = spark.createDataFrame([(1, -5.0, False, False), (1, -5.0, True, True)], "cell_id BIGINT, elevation DOUBLE, wide BOOLEAN, near BOOLEAN")
    hist, totals = events.hypsometry(px)
    levels = spark.createDataFrame([(1, 0.0)], "cell_id BIGINT, level DOUBLE")
    r = events.coastal_exposure(hist, totals, events.calibration_curve(hist), levels).collect()[0]
    assert r["exposed"] == 0.5 and r["percentile"] == pytest.approx((100 + 1) / 2)


def test_chain_accumulates_and_cycles_are_refused(spark):
    n = 40
    edges = spark.createDataFrame([(i, i - 1 if i else None, 1) for i in range(n)], "cell_id BIGINT, next_id BIGINT, payload BIGINT")
    got = {r["cell_id"]: r["payload"] for r in graph.accumulate_downstream(edges, edges).collect()}
    assert got == {i: n - i for i in range(n)}
    depth = {r["cell_id"]: r["depth"] for r in graph.assert_acyclic(edges).collect()}
    assert depth[n - 1] == n - 1
    ring = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "cell_id BIGINT, next_id BIGINT")
    with pytest.raises(ValueError):
        graph.assert_acyclic(ring)
    with pytest.raises(ValueError):
        graph.peel_rounds(ring)
    with pytest.raises(ValueError):
        graph.accumulate_downstream(ring, ring.select("cell_id", F.lit(1).alias("payload")))


def test_longest_paths_of_a_long_chain_and_of_random_trees(spark):
    n = 10_000
    chain = spark.range(n).select(F.col("id").alias("cell_id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("next_id"))
    got = graph.peel_rounds(chain)
    assert got.where(F.col("peel") != n - 1 - F.col("cell_id")).isEmpty() and got.count() == n
    rng = random.Random(4)
    down = {i: rng.randrange(max(0, i - 3), i) if i % 17 else None for i in range(300)}
    want = {i: 0 for i in down}
    for i in sorted(down, reverse=True):
        if down[i] is not None:
            want[down[i]] = max(want[down[i]], want[i] + 1)
    edges = spark.createDataFrame(list(down.items()), "cell_id BIGINT, next_id BIGINT")
    assert {r["cell_id"]: r["peel"] for r in graph.peel_rounds(edges).collect()} == want


def flood(cells, n_cols, eight):
    left, out = set(cells), {}
    for start in sorted(cells):
        front, seen = [start], set()
        while front:
            r, c = front.pop()
            if (r, c) in left:
                left.remove((r, c))
                seen.add((r, c))
                front += [(r + a, (c + b) % n_cols) for a in (-1, 0, 1) for b in (-1, 0, 1) if eight or not (a and b)]
        least = min((a * n_cols + b for a, b in seen), default=None)
        out.update(dict.fromkeys(seen, least))
    return out


@pytest.mark.parametrize("eight", [True, False])
def test_components_over_many_tiles_equal_a_flood_fill(spark, eight):
    rng = np.random.default_rng(9)
    n_cols = 300
    cells = {(r, c) for r, c in zip(*np.nonzero(rng.random((200, n_cols)) < 0.45))}
    # a snake that winds through all tiles
    cells |= {(300 + r, c) for r in range(0, 160, 2) for c in range(200)} | {(301 + r, 199 * (r // 2 % 2 == 0)) for r in range(0, 158, 2)}
    frame = spark.createDataFrame([(int(r), int(c)) for r, c in cells], "grow INT, gcol INT")
    got = {(r["grow"], r["gcol"]): r["component"] for r in graph.connected_components(frame, n_cols, eight).collect()}
    assert got == flood({(int(r), int(c)) for r, c in cells}, n_cols, eight)


def plain_smooth(points, weight, n_cols, by_mask):
    """{cell: sum(w v) / sum(w)} over all other cells, the weight given (row of the target, di, dj)."""
    out = {}
    for (r, c), v in points.items():
        if v is None and not by_mask:
            continue
        total = norm = 0.0
        for (r2, c2), u in points.items():
            for turn in (-1, 0, 1) if n_cols else (0,):
                w = weight(r, r - r2, c - c2 + turn * (n_cols or 0))
                total += w * (u or 0.0)
                norm += w if by_mask or u is not None else 0.0
        out[r, c] = total / norm
    return out


def test_tiled_kernels_equal_plain_sums(spark):
    rng = random.Random(6)
    for n_cols, rows, cols in ((720, range(28, 40), [*range(0, 12), *range(28, 38), *range(700, 720)]), (40, range(0, 70, 3), range(40))):
        points = {(r, c): None if rng.random() < 0.3 else rng.random() for r in rows for c in cols if rng.random() < 0.6}
        frame = spark.createDataFrame([("m", r, c, v) for (r, c), v in points.items()], "member STRING, grow INT, gcol INT, value DOUBLE").repartition(3)

        def latitude(row, di, dj):
            if abs(di) > 2 or abs(dj) > 2:
                return 0.0
            return math.exp(-math.hypot(di, dj * math.cos(math.radians(89.75 - 0.5 * row))) / 2.5)

        def gauss(row, di, dj, s=(1.0, 0.8)):
            if abs(di) > int(4 * s[0] + 0.5) or abs(dj) > int(4 * s[1] + 0.5):
                return 0.0
            return math.exp(-di * di / (2 * s[0] ** 2) - dj * dj / (2 * s[1] ** 2))

        index = lambda row, di, dj: math.exp(-math.hypot(di, dj) / 2.5) if max(abs(di), abs(dj)) <= 2 else 0.0
        shown = lambda df, col="value": {(r["grow"], r["gcol"]): r[col] for r in df.collect()}
        assert shown(grids.smooth_exp(frame, ["member"], n_cols=n_cols)) == pytest.approx(plain_smooth(points, latitude, n_cols, True))
        assert shown(grids.smooth_exp_index(frame, ["member"], n_cols=n_cols)) == pytest.approx(plain_smooth(points, index, n_cols, False))
        both = grids.nan_aware_gaussians(frame, ["member"], {"a": (1.0, 0.8), "b": (0.0, 0.0)}).cache()
        assert shown(both, "a") == pytest.approx(plain_smooth(points, gauss, None, False))
        assert shown(both, "b") == {k: v for k, v in points.items() if v is not None}


def test_tiles_shuffle_little_more_than_the_cells(spark):
    frame = spark.range(200 * 720).select((F.col("id") % 200).cast("int").alias("grow"), F.floor(F.col("id") / 200).cast("int").alias("gcol"), F.lit(1.0).alias("value"))
    assert Tiling.around(2, 2, 720).deal(frame, "grow", "gcol").count() < 1.35 * 200 * 720


def test_components_join_across_the_antimeridian(spark):
    cells = spark.createDataFrame([(5, 719), (5, 0), (6, 1), (9, 9), (20, 300), (21, 301)], "grow INT, gcol INT")
    got = graph.connected_components(cells).groupBy("component").agg(F.count("*").alias("n")).collect()
    assert sorted(r["n"] for r in got) == [1, 2, 3]


def test_slopes_agree_is_three_valued(spark):
    rows = [(1.0, 2.0), (1.0, -2.0), (0.0, 0.0), (0.0, 3.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "o DOUBLE, s DOUBLE").select(scalar.slopes_agree("o", "s").alias("a"))
    assert [r["a"] for r in df.collect()] == [True, False, None, False, None]


def test_unassessed_is_not_the_same_as_not_vulnerable(spark):
    v = spark.createDataFrame([(1, "L0", "ssp585", 2050, None), (2, "L0", "ssp585", 2050, 10.0)], "asset_id BIGINT, layer_id STRING, scenario STRING, decade INT, percentile DOUBLE")
    a = spark.createDataFrame([(1, "L0;L1"), (2, "L0")], "asset_id BIGINT, layer_ids STRING")
    h = spark.createDataFrame([("L0",)], "layer_id STRING")
    got = {r["asset_id"]: r["status"] for r in portfolio.vulnerability(v, a, h, 80.0).collect()}
    assert got == {1: "NOT_ASSESSED", 2: "NOT_VULNERABLE"}


def test_score_rounds_half_even(spark):
    got = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x DOUBLE").select(portfolio.half_even(F.col("x"), 2).alias("r"))
    assert [r["r"] for r in got.collect()] == [0.12, 0.38, 2.5]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_fuzzy_match_equals_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    queries = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 8))) for _ in range(80)]

    def score(q, w):
        s = 1.0 if q == w else 1 - edits(q, w) / max(len(q), len(w))
        return max(s, 0.8) if q in w and q != w else s

    got = delivery.fuzzy_match(
        spark.createDataFrame([(q,) for q in queries], "name STRING"), spark.createDataFrame([(w,) for w in words], "entry STRING")
    )
    for r in got.collect():
        best = max(score(r["query"], w) for w in words)
        assert (r["score"] or 0.0) == pytest.approx(best if best >= 0.6 else 0.0)


def test_fuzzy_candidates_are_few_and_complete(spark):
    rng = random.Random(11)
    entries = list({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 13))) for _ in range(400)})
    queries = []
    for w in entries[:150]:
        x = list(w)
        for _ in range(rng.randrange(0, 3)):
            x[rng.randrange(len(x))] = rng.choice("abcdefghij")
        queries.append("".join(x[rng.randrange(0, 2) :]))
    q, e = (spark.createDataFrame([(x,) for x in set(xs)], f"{n} STRING") for xs, n in ((queries, "query"), (entries, "low")))
    pairs = delivery.fuzzy_candidates(q, e, 0.6).collect()
    assert len(pairs) < 0.01 * len(set(queries)) * len(entries)
    got = {(r["query"], r["low"]) for r in pairs}
    for a in set(queries):
        for b in entries:
            if a in b or (abs(len(a) - len(b)) <= 0.4 * max(len(a), len(b)) and edits(a, b) <= 0.4 * max(len(a), len(b)) + 1e-9):
                assert (a, b) in got


def test_kendall_p_counts_pairs_like_brute_force():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 6, 50).astype(float), rng.integers(0, 6, 50).astype(float)
    assert 0 <= kendall_p(x, y) <= 1
    assert kendall_p(np.arange(30.0), np.arange(30.0)) < 1e-6
    assert kendall_p(np.arange(30.0), np.ones(30)) is None


def test_kendall_of_many_arrays_at_once_equals_brute_force():
    rng = np.random.default_rng(13)
    sizes = [0, 1, 2, 3, 17, 64, 65, 200]
    row = np.repeat(np.arange(len(sizes)), sizes)
    x, y = rng.integers(0, 9, len(row)).astype(float), rng.integers(0, 5, len(row)).astype(float)
    s, var = kendall(row, x, y, len(sizes))
    for k, n in enumerate(sizes):
        a, b = x[row == k], y[row == k]
        assert s[k] == sum(np.sign(a[j] - a[i]) * np.sign(b[j] - b[i]) for i in range(n) for j in range(i + 1, n))
        assert np.isnan(var[k]) if n < 3 else var[k] >= 0


def test_log_gamma_and_pearson3_quantiles():
    a = np.array([0.01, 0.3, 0.5, 1.0, 1.5, 7.2, 50.0, 52.0, 171.3, 1e5])
    assert log_gamma(a) == pytest.approx([math.lgamma(x) for x in a], rel=1e-13, abs=1e-13)
    skew = np.array([0.0, 0.4, -0.4, 1.7, -2.2])
    for q in (0.05, 0.5, 0.95):
        assert pearson3_exceedance(skew, pearson3_quantile(q, skew)) == pytest.approx(np.full(5, 1 - q), abs=1e-9)
    assert pearson3_quantile(0.975, np.array([0.0]))[0] == pytest.approx(1.959963984540054)
    same = [np.array([10.0, 12.0]), np.array([2.0, 1.0]), np.array([0.1, -0.2])]
    assert shifted_periods(same, same, 20.0) == pytest.approx([20.0, 20.0])


def test_pearson3_of_symmetric_moments_is_normal():
    m, s, g = pearson3_parameters(3.0, 1.0, 0.0)
    assert (m, g) == (3.0, 0.0) and s == pytest.approx(math.sqrt(math.pi))


def test_gamma_quartiles_of_large_shapes():
    for shape, quartile in ((1e6, 999325.3), (1e7, 9997866.9)):
        assert gamma_ppf(0.25, np.array([shape]))[0] == pytest.approx(quartile, abs=0.2)


def test_nearest_source_across_the_pole(spark):
    target = spark.createDataFrame([(1, 89.75, 0.0)], "target_id BIGINT, lat DOUBLE, lon DOUBLE")
    source = spark.createDataFrame([(7, 89.25, 179.75)], "source_id BIGINT, lat DOUBLE, lon DOUBLE")
    assert spatial.nearest_valid(target, source, 250.0).first()["source_id"] == 7


def test_boxes_rings_and_polygons_past_the_antimeridian(spark):
    box = spark.createDataFrame([(1, 0.0, 0.5, 179.5, 181.0)], "box_id BIGINT, south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE")
    assert {r["gcol"] for r in spatial.box_shares(box).collect()} == {719, 0, 1}
    edges = [(1, 170.0, -5.0, 190.0, -5.0), (1, 190.0, -5.0, 190.0, 5.0), (1, 190.0, 5.0, 170.0, 5.0), (1, 170.0, 5.0, 170.0, -5.0)]
    polygon = spark.createDataFrame(edges, "polygon_id BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    points = spark.createDataFrame([(1, 0.2, 175.0), (2, 0.2, -175.0), (3, 0.2, -165.0)], "point_id BIGINT, lat DOUBLE, lon DOUBLE")
    assert {r["point_id"] for r in rings.points_in_polygons(points, polygon).collect()} == {1, 2}


def test_a_hole_is_taken_off(spark):
    square = lambda a, b: ([a, b, b, a], [a, a, b, b])
    rings = [(1, *square(0.0, 2.0), False), (1, *square(0.5, 1.0), True)]
    shares = spatial.ring_shares(spark.createDataFrame(rings, "box_id BIGINT, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>, hole BOOLEAN"))
    assert sum(r["w"] for r in shares.collect()) * 0.25 == pytest.approx(4 - 0.25)


def _chunk_files(spark, folder, chunks):
    for i, (name, first, last) in enumerate(chunks):
        rows = spark.range(first, last).select(
            F.lit(name).alias("chunk_id"), F.lit("m").alias("member"), F.lit(1).cast("bigint").alias("cell_id"),
            F.date_from_unix_date(F.col("id").cast("int")).alias("day"), (F.col("id") % 7).cast("double").alias("value"),
        )
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    return f"{folder}/*"


def test_ingest_keeps_old_days_and_drops_repeated_chunks(spark, tmp_path):
    path = _chunk_files(spark, tmp_path / "in", [("c", 12000, 12400), ("b", 11000, 11366), ("a", 10957, 11000), ("c", 12000, 12400)])
    stream = incremental.read_chunks(spark, path)
    incremental.ingest_once(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert incremental.ingested(spark, f"{tmp_path}/out").count() == 400 + 366 + 43


def test_five_day_sums_of_chunks_in_any_order(spark, tmp_path):
    path = _chunk_files(spark, tmp_path / "in", [("b", 105, 121), ("a", 101, 105), ("a", 101, 105), ("d", 125, 140), ("c", 121, 125)])
    incremental.run_to_end(incremental.stream_five_day_sums(incremental.read_chunks(spark, path)), f"{tmp_path}/out", f"{tmp_path}/cp", "append")
    got = {r["day_number"]: r["sum5"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {d: float(sum((d - k) % 7 for k in range(5))) for d in range(105, 140)}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 35


def test_cells_of_a_block_share_a_state_and_keep_their_own_series(spark, tmp_path):
    cells = [None, -70, -1, 0, 1, 63, 64, 4_000_000_000_000]
    rows = [(f"c{d // 4}", m, c, datetime.date(1970, 1, 1) + datetime.timedelta(days=d - 6), float(d * d + i)) for m in ("m", "n") for i, c in enumerate(cells) for d in range(12) if d != i]
    for name in ("c2", "c0", "c1"):
        spark.createDataFrame([r for r in rows if r[0] == name], incremental.CHUNK_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = incremental.stream_five_day_sums(incremental.read_chunks(spark, f"{tmp_path}/in"))
    incremental.run_to_end(stream, f"{tmp_path}/out", f"{tmp_path}/cp", "append")
    got = [(r["member"], r["cell_id"], r["day_number"], r["sum5"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    full = [(m, c, i, d) for m in ("m", "n") for i, c in enumerate(cells) for d in range(4, 12) if not d - 4 <= i <= d]
    ids = [incremental.NO_CELL if c is None else c for c in cells]
    assert sorted(got) == sorted((m, ids[i], d - 6, float(sum((d - k) ** 2 + i for k in range(5)))) for m, _, i, d in full)


def test_a_micro_batch_takes_a_chunk_whatever_its_files(spark, tmp_path):
    from querybook.daily_metrics import st2

    start = datetime.datetime(2024, 1, 1)
    events_ = [(u, "view", start + datetime.timedelta(days=d), float(u + d)) for u in range(40) for d in range(30)]
    spark.createDataFrame(events_, "user_id BIGINT, event_type STRING, ts TIMESTAMP, value DOUBLE").write.parquet(f"{tmp_path}/events.parquet")
    made = []
    real = incremental.run_to_end
    try:
        incremental.run_to_end = lambda stream, output, *rest: (made.append(output), real(stream, output, *rest))[1]
        assert st2(spark, str(tmp_path)).count() == 14
    finally:
        incremental.run_to_end = real
    assert len(list(Path(made[0].removeprefix("file:")).glob("batch=*"))) == 3


def test_rows_ingested_before_are_not_sent_to_the_driver(spark, tmp_path):
    path = _chunk_files(spark, tmp_path / "in", [("c", 12000, 12400), ("c", 12000, 12400)])
    plans = []
    frame = type(spark.range(1))
    real = frame.join
    try:
        frame.join = lambda self, *how: (plans.append(real(self, *how)), plans[-1])[1]
        incremental.ingest_once(incremental.read_chunks(spark, path), f"{tmp_path}/out", f"{tmp_path}/cp")
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    finally:
        frame.join = real
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_a_chunk_that_comes_again_adds_no_rows_with_null_keys(spark, tmp_path):
    day = datetime.date(2024, 1, 1)
    rows = [(None, "m", 1, day, 1.0), ("c", None, 1, day, 1.0), ("c", "m", None, day, 1.0), ("c", "m", 1, None, None), ("c", "m", 1, day, 1.0)]
    for _ in range(2):
        spark.createDataFrame(rows, incremental.CHUNK_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    incremental.ingest_once(incremental.read_chunks(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert incremental.ingested(spark, f"{tmp_path}/out").count() == 5


def test_points_of_a_batch_of_tiles_are_unpacked_a_stack_at_a_time():
    n, per = 2000, 36 * 36
    r, c = (x.ravel().astype(np.int32) for x in np.mgrid[-2:34, -2:34])
    flat = pa.StructArray.from_arrays([pa.array(np.tile(r, n)), pa.array(np.tile(c, n)), pa.array(np.arange(n * per) % 11, pa.float64())], ["r", "c", "v"])
    points = pa.ListArray.from_arrays(np.arange(0, n * per + 1, per, dtype=np.int32), flat)
    zeros = pa.array(np.zeros(n, np.int32))
    batch = pa.RecordBatch.from_arrays([zeros, zeros, points], names=["_tr", "_tc", "_points"])
    tracemalloc.start()
    total = sum(float(sums.sum()) for _, _, sums, _, _ in tiles._stacks(batch, tiles.Tiling(32, 32, 2, 2)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == float((np.arange(n * per) % 11).sum()) and peak < 60e6


def test_coastal_panels_read_the_exposure_once(spark):
    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda x: (seen.add(1), x)[1], "double")
    rows = [("s", c, y, 0.1 * (y - 1990) + c, float(c)) for c in range(5) for y in range(1995, 2001)] + [("s", None, 1995, 1.0, 1.0)]
    plain = spark.createDataFrame(rows, "scenario STRING, cell_id BIGINT, year INT, share DOUBLE, percentile DOUBLE")
    exposure = plain.withColumn("exposed", mark(F.col("share"))).drop("share")
    got = {(r["cell_id"], r["decade"]): r for r in hazards.coastal_panels(exposure, [1995, 1997, 1999], 1995, 2).collect()}
    assert len(got) == 15 and got[(3, 1997)]["median"] == pytest.approx(3.75) and got[(3, 1997)]["percentile"] == 3.0
    assert got[(3, 1999)]["ols_slope"] == pytest.approx(0.1) and got[(3, 1995)]["sen_slope"] is None
    assert seen.value <= len(rows)


def test_a_cell_in_the_band_has_no_percentile_without_a_curve(spark):
    px = spark.createDataFrame([(1, -1.0, True, True), (2, -20.0, True, True)], "cell_id BIGINT, elevation DOUBLE, wide BOOLEAN, near BOOLEAN")
    hist, totals = events.hypsometry(px)
    levels = spark.createDataFrame([(1, -5.0), (1, 0.0), (2, 0.0), (3, 0.0)], "cell_id BIGINT, level DOUBLE")
    got = {(r["cell_id"], r["level"]): (r["exposed"], r["percentile"]) for r in events.coastal_exposure(hist, totals, events.calibration_curve(hist), levels).collect()}
    assert got == {(1, -5.0): (0.0, None), (1, 0.0): (1.0, 100.0), (2, 0.0): (1.0, 100.0)}


def star(n, cx, cy, big, small, seed, snap=7):
    """A ring of n corners around (cx, cy), every `snap`-th on grid lines."""
    rng = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    far = rng.uniform(small, big, n)
    ring = np.column_stack([cx + far * np.cos(angle), cy + far * np.sin(angle)])
    ring[::snap] = np.round(ring[::snap] * 2) / 2
    return ring


def test_edge_shares_equal_clipping_with_holes_and_any_turn(spark):
    outer, hole, other = star(60, 178.0, 12.0, 6.0, 3.0, 1), star(20, 178.2, 12.1, 2.0, 1.0, 2)[::-1], star(9, 100.3, -40.0, 1.5, 0.5, 3)[::-1]
    polygons = [(1, outer, False), (1, hole, True), (2, other, None)]
    frame = spark.createDataFrame([(i, r[:, 0].tolist(), r[:, 1].tolist(), h) for i, r, h in polygons], "box_id BIGINT, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>, hole BOOLEAN")
    want = {}
    for i, ring, h in polygons:
        for r in range(0, 360):
            for c in range(520, 760):
                w, n = -180 + c / 2, 90 - r / 2
                if ring[:, 0].max() < w or ring[:, 0].min() > w + 0.5 or ring[:, 1].min() > n or ring[:, 1].max() < n - 0.5:
                    continue
                share = clip_area(ring, w, n - 0.5, w + 0.5, n) / 0.25 * (-1 if h else 1)
                want[i, r, c % 720] = want.get((i, r, c % 720), 0.0) + share
    want = {k: v for k, v in want.items() if v > 1e-9}
    got = {(r["box_id"], r["grow"], r["gcol"]): r["w"] for r in spatial.ring_shares(frame).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    corners = [(i, k, h, *map(float, ring[j]), *map(float, ring[(j + 1) % len(ring)])) for k, (i, ring, h) in enumerate(polygons) for j in range(len(ring))]
    edges = spark.createDataFrame(corners, "box_id BIGINT, ring_id INT, hole BOOLEAN, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    again = {(r["box_id"], r["grow"], r["gcol"]): r["w"] for r in rings.edge_shares(rings.signed_edges(edges)).collect()}
    assert again == pytest.approx(got, abs=1e-12)


def test_a_ring_of_100_000_corners_covers_its_area(spark):
    ring = star(100_000, 10.0, 20.0, 5.0, 4.99, 4, 100_000)
    frame = spark.createDataFrame([(1, ring[:, 0].tolist(), ring[:, 1].tolist())], "box_id BIGINT, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>")
    x, y = ring.T
    area = 0.5 * abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))
    shares = spatial.ring_shares(frame).agg(F.sum("w"), F.max("w")).first()
    assert shares[0] * 0.25 == pytest.approx(area, rel=1e-9) and shares[1] == pytest.approx(1.0, abs=1e-9)


def test_points_in_polygons_equal_ray_casting(spark):
    rng = np.random.default_rng(7)
    shapes = {1: [star(40, 179.0, 3.0, 4.0, 1.0, 5), star(12, 179.0, 3.0, 0.9, 0.4, 6)], 2: [star(30, 178.0, 4.0, 2.0, 1.0, 8)]}
    edges = [(p, *map(float, r[j]), *map(float, r[(j + 1) % len(r)])) for p, rs in shapes.items() for r in rs for j in range(len(r))]
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-2, 9, 600), rng.uniform(174, 184, 600)))]
    points += [(600 + i, a, b) for i, (a, b) in enumerate(itertools.product(np.arange(0, 6, 0.5).tolist(), np.arange(176, 182, 0.5).tolist()))]

    def inside(p, y, x):
        return sum((y0 > y) != (y1 > y) and x < x0 + (y - y0) * (x1 - x0) / (y1 - y0) for q, x0, y0, x1, y1 in edges if q == p) % 2

    want = {(i, p) for i, y, x in points for p in shapes if inside(p, y, x)}
    frame = spark.createDataFrame([(i, y, x - 360 if x >= 180 else x) for i, y, x in points], "point_id BIGINT, lat DOUBLE, lon DOUBLE")
    got = rings.points_in_polygons(frame, spark.createDataFrame(edges, "polygon_id BIGINT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")).collect()
    assert len(got) == len(want) and {(r["point_id"], r["polygon_id"]) for r in got} == want


def test_digest_of_a_file_above_two_gigabytes(spark, tmp_path):
    big, small = tmp_path / "big.bin", tmp_path / "with space.bin"
    with big.open("wb") as f:
        f.truncate((2 << 30) + 5)  # takes no disk
    small.write_bytes(b"abc")
    got = {r["file"]: (r["bytes"], r["sha256"]) for r in sinks.provenance(spark, str(tmp_path)).collect()}
    plain = hashlib.sha256()
    for _ in range(2 << 10):
        plain.update(bytes(1 << 20))
    plain.update(bytes(5))
    assert got == {"big.bin": ((2 << 30) + 5, plain.hexdigest()), "with space.bin": (3, hashlib.sha256(b"abc").hexdigest())}


def test_exact_ks_p_counts_orders(spark):
    for n, m in ((3, 4), (5, 5), (6, 2)):
        strays = []
        for chosen in itertools.combinations(range(n + m), n):
            i = j = 0
            far = 0.0
            for k in range(n + m):
                i, j = (i + 1, j) if k in chosen else (i, j + 1)
                far = max(far, abs(i / n - j / m))
            strays.append(far)
        ds = sorted(set(strays))
        frame = spark.createDataFrame([(d, n, m) for d in ds], "d DOUBLE, n BIGINT, m BIGINT")
        got = [r[0] for r in frame.select(compare.exact_ks_p(F.col("d"), F.col("n"), F.col("m"))).collect()]
        assert got == pytest.approx([sum(s >= d - 1e-9 for s in strays) / len(strays) for d in ds])
    near = spark.createDataFrame([(0.14, 99, 101)], "d DOUBLE, n BIGINT, m BIGINT").select(*[f(F.col("d"), F.col("n"), F.col("m")) for f in (compare.exact_ks_p, compare.kolmogorov_p)]).first()
    assert near[0] == pytest.approx(near[1], abs=0.05)


def test_a_batch_opens_the_folders_of_its_own_chunks_only(spark, tmp_path):
    schema = "chunk_id STRING, member STRING, cell_id BIGINT, day DATE, value DOUBLE"
    day = datetime.date(2024, 1, 1)
    for i in range(4):
        rows = [(f"c/{i}:x", "m", c, day, 1.0) for c in range(3)] + ([("c/0:x", "m", 9, day, 2.0), ("c/0:x", "m", 1, day, 1.0)] if i == 3 else [])
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    opened = []
    real = type(spark.read).parquet
    reader = type(spark.read)
    try:
        reader.parquet = lambda self, *paths, **k: (opened.append(paths), real(self, *paths, **k))[1]
        incremental.ingest_once(incremental.read_chunks(spark, f"{tmp_path}/in", schema=schema), f"{tmp_path}/out", f"{tmp_path}/cp")
    finally:
        reader.parquet = real
    kept = incremental.ingested(spark, f"{tmp_path}/out", schema)
    assert kept.count() == 13 and kept.where("chunk_id = 'c/0:x'").count() == 4
    assert sum(len(paths) for paths in opened) <= 2  # only the chunk that came again


def test_differences_name_every_altered_number(spark):
    schema = "k INT, a DOUBLE, b DOUBLE"
    made = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, None), (3, None, 4.0), (5, 1.0, 1.0)], schema)
    again = spark.createDataFrame([(1, 1.0, 2.0 + 1e-12), (2, 1.5, 3.0), (3, 0.0, 4.0), (4, 1.0, 1.0)], schema)
    got = {(r["k"], r["item"], r["problem"]) for r in recompute.differences(made, again, ["k"], ["a", "b"]).collect()}
    assert got == {(2, "a", "differs"), (2, "b", "absent"), (3, "a", "absent"), (4, "*", "missing"), (5, "*", "extra")}
    invented = recompute.differences(again, made, ["k"], ["a", "b"]).where("problem = 'invented'").collect()
    assert {(r["k"], r["item"]) for r in invented} == {(2, "b"), (3, "a")}


def test_far_and_near_sites_snap_like_brute_force(spark):
    rng = random.Random(12)
    grid_rows = [(r, c, 90 - 0.25 - 0.5 * r, -180 + 0.25 + 0.5 * c) for r in range(40, 140) for c in [*range(0, 60), *range(690, 720)]]
    cells = [(i, r, c, la, lo, (r // 50) * 10 + (c > 300)) for i, (r, c, la, lo) in enumerate(grid_rows)]
    basins = spark.createDataFrame([(r, c, b) for _, r, c, _, _, b in cells], "grow INT, gcol INT, basin_id INT")
    river = [x for x in cells if rng.random() < 0.002]
    rivers = spark.createDataFrame([(b, i, r, c, la, lo, i) for i, r, c, la, lo, b in river], "basin_id INT, cell_id BIGINT, grow INT, gcol INT, lat DOUBLE, lon DOUBLE, upstream BIGINT")
    sites = [(i, la + rng.uniform(-0.2, 0.2), lo + rng.uniform(-0.2, 0.2), b) for i, (_, _, _, la, lo, b) in enumerate(rng.sample(cells, 200))]
    got = spatial.snap_to_river(spark.createDataFrame([s[:3] for s in sites], "site_id BIGINT, lat DOUBLE, lon DOUBLE"), basins, rivers, 200.0).collect()
    found = {r["site_id"]: r["snap_km"] for r in got}

    def km(a, b, c, d):
        p, q = math.radians(a), math.radians(c)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0088 * math.asin(math.sqrt(h))

    for i, la, lo, b in sites:
        near = min((km(la, lo, y, x) for _, _, _, y, x, basin in river if basin == b), default=None)
        assert found[i] == (pytest.approx(near, abs=1e-5) if near is not None else None)


def test_empty_tables_give_empty_results(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    cells = none("grow INT, gcol INT, value DOUBLE")
    assert graph.connected_components(cells).count() == 0
    assert graph.peel_rounds(none("cell_id BIGINT, next_id BIGINT")).count() == 0
    assert grids.smooth_exp(cells, []).count() == 0 and grids.nan_aware_gaussian(cells, [], 1.0, 1.0).count() == 0
    assert spatial.ring_shares(none("box_id INT, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>")).count() == 0
    edges = none("polygon_id INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE")
    assert rings.points_in_polygons(none("point_id INT, lat DOUBLE, lon DOUBLE"), edges).count() == 0
    rows = none(ANNUAL)
    assert decadal.slopes(rows, [2020, 2030], 2020).count() == decadal.ols_slope(rows, [2020, 2030], 2020).count() == 0
    assert delivery.fuzzy_match(none("name STRING"), none("entry STRING")).count() == 0
    assert compare.ks_statistic(none("old_value DOUBLE, new_value DOUBLE")).collect()[0]["p_value"] is None


def test_rings_without_area_or_corners_cover_nothing(spark):
    flat = [(1, [0.0, 1.0, 2.0], [5.0, 5.0, 5.0]), (2, [3.0], [3.0]), (3, [], []), (4, None, None), (5, [0.0, 1.0, 1.0, 0.0], [0.0, 0.0, 1.0, 1.0])]
    frame = spark.createDataFrame(flat, "box_id INT, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>")
    got = spatial.ring_shares(frame).groupBy("box_id").agg(F.sum("w").alias("w")).collect()
    assert [(r["box_id"], r["w"]) for r in got] == [(5, 4.0)]
