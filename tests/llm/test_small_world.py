from __future__ import annotations

from math import acos

import numpy as np
import pytest

from cartwright.llm import small_world

DDL = "vec_id bigint, embedding array<float>, label int, rid int, shard string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], DDL)


def run(spark, rows):
    return sorted((tuple(r) for r in small_world.near_copies(table(spark, rows)).collect()), key=str)


def brute(rows, limit=0.95):
    """All cosines; components by repeated least label."""
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    near = np.zeros((len(rows), len(rows)), bool)
    for width in {len(v) for (_, v), good in zip(rows, ok) if good}:
        at = [k for k, good in enumerate(ok) if good and len(rows[k][1]) == width]
        x = np.array([rows[k][1] for k in at], np.float32).astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near[np.ix_(at, at)] = x @ x.T >= limit
    label = np.arange(len(rows))
    while True:
        lower = np.array([min(label[n].min(initial=k), label[k]) for k, n in enumerate(near)])
        if (lower == label).all():
            break
        label = lower
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [j for (j, _), m in zip(rows, label) if m == label[k] and j is not None]
        component = min(ids, default=None)
        out.append((i, int(near[k].sum()) - int(ok[k]), component, i == component))
    return sorted(out, key=str)


def families(rng, sizes, spread, width):
    """Groups around centres of length one, each member at about the given angle from its centre, in radians."""
    out = []
    for size, angle in zip(sizes, spread):
        centre = rng.standard_normal(width)
        centre /= np.linalg.norm(centre)
        off = rng.standard_normal((size, width))
        off /= np.linalg.norm(off, axis=1, keepdims=True)
        out.append((centre + np.tan(angle) * off) * rng.uniform(0.1, 30, (size, 1)))
    return np.concatenate(out)


def test_links_and_components_against_all_cosines(spark, small_parts, monkeypatch):
    monkeypatch.setattr(small_world, "QUERIES", 200)
    rng = np.random.default_rng(8)
    # Tight families count as whole balls, wide ones are compared member by member, and single vectors link with nothing.
    points = families(rng, [150, 80, 60, 40, 2, 2], [0.05, 0.15, 0.22, 0.3, 0.01, 0.2], 24)
    points = np.concatenate([points, rng.standard_normal((500, 24))])
    rows = [(i, p.astype(np.float32).tolist()) for i, p in enumerate(rng.permutation(points))]
    rows += [(2000 + i, rows[i % 7][1]) for i in range(60)]
    got, wanted = run(spark, rows), brute(rows)
    assert got == wanted


def test_copies_ties_and_what_links_with_nothing(spark, small_parts):
    e = [1.0, 0.0, 0.0]
    rows = [(i, e) for i in range(30)] + [(7, e), (None, e), (40, [3.0, 0.0, 0.0]), (41, [0.0, 1.0, 0.0]), (50, None), (51, [0.0] * 3), (52, []),
                                          (53, [1.0, None, 0.0]), (54, [float("nan"), 1.0, 0.0]), (55, [float("inf"), 0.0, 0.0]), (56, [1.0, 0.0]), (57, [2.0, 0.0]),
                                          (None, [0.0, 0.0, 1.0]), (None, None), (60, [1e-38, 0.0, 0.0]), (61, [3e38, 3e38, 3e38])]
    got = run(spark, rows)
    assert got == brute(rows)
    assert (None, 0, None, True) in got and (None, 33, 0, False) in got and (57, 1, 56, False) in got
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_chains_join_and_the_limit_is_exact(spark, small_parts):
    step = acos(0.95) * 0.999
    rows = [(i, [float(np.cos(i * step)), float(np.sin(i * step))]) for i in range(12)] + [(100, [19.0, 0.0]), (101, [0.95, (1 - 0.95**2) ** 0.5 + 1e-6])]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("kind", ["round", "clusters"])
def test_graph_finds_its_own_vectors(kind):
    rng = np.random.default_rng(4)
    points = rng.standard_normal((3000, 32)) if kind == "round" else families(rng, [100] * 30, [0.6] * 30, 32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph, rows, ball = small_world.build(points, small_world.level_of(np.arange(3000)), acos(0.95) / 2)
    q = graph.vectors[:-1]
    beam = small_world.audited(graph, q[::10], 0.9)
    found = np.zeros(len(q), bool)
    for a, b in small_world.in_reach(graph, q, 0.9, beam):
        found[a[a == b]] = True
    assert found.mean() >= 0.99 and beam < 200
    assert (np.einsum("ij,ij->i", points, points[rows[ball]]) >= 0.95).all()


def test_the_audit_widens_a_beam_that_finds_too_little():
    rng = np.random.default_rng(9)
    points = rng.standard_normal((600, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph, _, _ = small_world.build(points, small_world.level_of(np.arange(600)), 0.01)
    graph.links = [np.where(rng.random(graph.links[0].shape) < 0.93, -1, graph.links[0])]  # a graph in pieces
    sample = graph.vectors[:200]
    beam = small_world.audited(graph, sample, 0.9)
    hit = sum(int((a == b).sum()) for a, b in small_world.in_reach(graph, sample, 0.9, beam))
    assert beam > 2 * small_world.BEAM and hit >= 198


def test_a_family_is_one_node():
    rng = np.random.default_rng(1)
    points = families(rng, [2000], [0.06], 32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph, rows, _ = small_world.build(points, small_world.level_of(np.arange(2000)), acos(0.95) / 2 - 1e-3)
    assert len(rows) == 1 and len(graph.vectors) == 2
