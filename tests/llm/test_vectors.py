from __future__ import annotations

import numpy as np
import pytest

from larder.llm import near_vectors, nearest
from larder.llm.components import connected

SCHEMA = "vec_id bigint, embedding array<float>, label int, block int, n int"


def data(n=700, dimension=16, seed=1):
    """Random vectors, groups of near copies, one large group, copies, and vectors that take no part."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n, dimension)) * rng.uniform(0.5, 2, size=(n, 1))
    for start, size in ((0, 150), (200, 30), (300, 5)):
        vectors[start : start + size] = vectors[start] + rng.normal(size=(size, dimension)) * 0.05
    vectors[400:420] = vectors[400]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    odd = [
        (9001, None),
        (9002, [0.0] * dimension),
        (9003, [None, *[1.0] * (dimension - 1)]),
        (9004, [float("nan")] * dimension),
        (9005, [float("inf"), *[1.0] * (dimension - 1)]),
        (9006, []),
        (9007, [1.0, 2.0]),
        (None, [1.0] * dimension),
    ]
    return rows, odd


@pytest.fixture(scope="module")
def frame(spark):
    from larder.llm.shared import ship_package

    ship_package(spark)
    return lambda rows: spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA).repartition(3)


def exact_links(rows):
    x = np.array([v for _, v in rows])
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    links = x @ x.T >= 0.9
    np.fill_diagonal(links, False)
    return links


def test_near_duplicates(frame, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 64)  # several blocks in the large group's lists
    rows, odd = data()
    out = near_vectors.near_duplicates(frame([*rows, *odd, rows[5]]), n_pivots=64).collect()
    assert len(out) == len(rows) + len(odd) + 1
    got = {r.vec_id: r for r in out}
    links = exact_links(rows)
    wanted, found = links.sum(1), np.array([got[i].n_links for i, _ in rows])
    assert (found <= wanted).all() and found.sum() >= 0.9 * wanted.sum()
    assert {got[i].component_id for i in range(150)} == {0} and {got[i].component_id for i in range(400, 420)} == {400}
    assert all(got[i].n_links >= 19 for i in range(400, 420))
    for i, _ in odd:
        assert got[i].n_links == 0 and got[i].component_id == i
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)


def test_nearest(frame, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 200)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 16)
    rows, odd = data()
    out = nearest.search(frame([*rows, *odd]), "vec_id % 20 = 0").collect()
    x = np.array([v for _, v in rows])
    hits = 0
    for q in range(0, len(rows), 20):
        mine = sorted((r.rank, r.vec_id, r.score) for r in out if r.query_id == q)
        assert [r[0] for r in mine] == list(range(1, 21)) and q not in [r[1] for r in mine]
        score = x @ x[q]
        assert all(abs(s - score[i]) < 1e-9 for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        hits += len(set(order) & {r[1] for r in mine})
    assert hits >= 0.9 * 20 * len(range(0, len(rows), 20))
    assert {r.query_id for r in out} == set(range(0, len(rows), 20))


def test_nearest_with_one_vector_in_a_third_of_the_rows(frame):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 16))
    vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    vectors[::3] = vectors[0]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    out = nearest.search(frame(rows), "vec_id % 300 in (0, 1)").collect()
    for q in range(0, 3000, 300):  # its own copies, the smallest ids first
        mine = [r.vec_id for r in sorted(out, key=lambda r: r.rank) if r.query_id == q]
        assert mine == [i for i in range(0, 66, 3) if i != q][:20]
    assert all(sum(r.query_id == q for r in out) == 20 for q in range(1, 3000, 300))


def test_nearest_takes_whole_groups_up_to_its_cut(frame, monkeypatch):
    """Where a query does not take the whole table: all of the groups up to its cut, exactly, and not all of the table."""
    monkeypatch.setattr(nearest, "OPENED", 16)
    monkeypatch.setattr(nearest, "BLOCK", 700)
    monkeypatch.setattr(nearest, "AT_ONCE", 50)
    monkeypatch.setattr(nearest, "HELD", 30)
    monkeypatch.setattr(nearest, "TRIED", 100)
    taken = []
    choose = nearest.pivots.choose
    monkeypatch.setattr(nearest.pivots, "choose", lambda *a: taken.append(choose(*a)) or taken[-1])
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.4
    x = np.float32(x).astype(float)
    x[1000:1100] = x[1000]  # copies, more than are asked for
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    out = nearest.search(frame([*rows, rows[20], rows[3]]), "vec_id % 20 = 0").collect()
    chosen = taken[0]
    at = nearest.places(nearest.orders(x, chosen))
    first = np.argsort(at, axis=1)[:, :2]
    distinct = np.array([i for i in range(len(x)) if not 1000 < i < 1100])
    recalled = 0
    for q in range(0, len(x), 20):
        distance = at[q][first[:, 0]] + np.abs(at[q][first[:, 1]] - 1)
        held = np.cumsum(np.bincount(distance[distinct]))
        cut = np.searchsorted(held, 16 * 62)  # the root of 3901, in whole numbers, is 62
        assert held[cut] < 3000
        score = (x * x[q]).sum(axis=1)
        best = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q]
        mine = [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q]
        assert mine == [(i, score[i]) for i in best if distance[i] <= cut][:20]
        recalled += len({i for i, _ in mine} & set(best[:20]))
    assert recalled >= 0.9 * 20 * 200


def test_vectors_read_grow_with_the_root_of_the_table():
    def read(n):
        groups = np.array([(a, b) for a in range(64) for b in range(64) if a != b])
        at = nearest.places(np.stack([np.random.default_rng(i).permutation(64) for i in range(20)]))
        sizes = np.full(len(groups), n // len(groups))
        cut, files = nearest.cuts(at, groups, sizes, nearest.OPENED * int(sizes.sum() ** 0.5))
        distance = nearest.footrule(at, groups)
        assert (files == np.stack([(distance[:, groups[:, 0] == f] <= cut[:, None]).any(axis=1) for f in range(64)], axis=1)).all()
        return ((distance <= cut[:, None]) @ sizes).mean()

    assert read(16_000_000) < 4.5 * read(1_000_000)


def test_nearest_of_doubles(spark, frame):
    """Doubles that single precision does not hold, in size and in digits; near ties within its error."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 8))
    x[::3] = x[0] + rng.normal(size=(200, 8)) * 1e-9
    for scale in (1.0, 1e120):
        rows = [(i, (v * scale).tolist()) for i, v in enumerate(x)]
        out = nearest.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id % 60 = 0").collect()
        for q in range(0, 600, 60):
            score = (x * scale * (x[q] * scale)).sum(axis=1)
            best = [i for i in np.lexsort((np.arange(600), -score)) if i != q][:20]
            mine = [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q]
            assert mine == [(i, score[i]) for i in best]


def test_nearest_of_rows_that_share_an_id(frame):
    """Rows of one id are one vector; the same rows in any order give the same answer."""
    rng = np.random.default_rng(8)
    rows = [(i % 90, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(180)]
    found = [sorted(map(tuple, nearest.search(frame(r), "vec_id % 20 = 0").collect())) for r in (rows, rows[::-1] + rows[:50])]
    assert found[0] == found[1] and len(found[0]) == 5 * 20
    assert len({(q, i) for q, _, i, _ in found[0]}) == 100 and all(q != i for q, _, i, _ in found[0])


def test_few_and_no_vectors(frame):
    rows = [(20, [1.0, 0.0]), (40, [0.0, 1.0]), (3, [1.0, 1.0])]
    out = nearest.search(frame(rows), "vec_id % 20 = 0").orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in out] == [(20, 1, 3), (20, 2, 40), (40, 1, 3), (40, 2, 20)]
    for odd in ([], [(1, None)]):
        assert nearest.search(frame(odd), "vec_id % 20 = 0").collect() == []
        assert [r.n_links for r in near_vectors.near_duplicates(frame(odd)).collect()] == [0] * len(odd)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60) if i != 30] + [(100, 7), (200, 201), (201, 200), (5, 5)]
    out = {r.node: r.component for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert out == {i: 0 if i <= 30 else 31 for i in range(61)} | {100: 0, 200: 200, 201: 200}
