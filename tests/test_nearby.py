import numpy as np
import pytest

from cartoloom.geo.sphere import haversine
from cartoloom.geo.wkb import decode, encode
from cartoloom.operators.nearby import edges_of, near_and_inside, strictly_inside

POINTS = "id string, geometry binary, cell int, own string"


def point(x, y):
    return encode("POINT", [[[(float(x), float(y))]]])


def area(*rings):
    return encode("POLYGON", [[[tuple(map(float, p)) for p in r] for r in rings]])


SQUARE = [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]
HOLE = [(0.5, 0.5), (1, 0.5), (1, 1), (0.5, 1), (0.5, 0.5)]


def table(spark, rows):
    return spark.createDataFrame([(i, g, 1, "x") for i, g in rows], POINTS)


def pairs(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("rows_per_tile", [20_000, 40])
def test_against_brute_force(spark, rows_per_tile):
    r = np.random.default_rng(5)
    n = 600
    x, y = r.normal(10, 0.02, n), r.normal(45, 0.01, n)
    x[:200], y[:200] = 10.0, 45.0  # a third of all points on one spot
    x[:200] += (np.arange(200) % 7) * 1e-7
    ids = [f"p{i:04d}" for i in r.permutation(n)]
    areas = [(f"q{k}", area([(a, b), (a + 0.01, b), (a + 0.005, b + 0.008), (a, b)])) for k, (a, b) in enumerate(zip(r.normal(10, 0.02, 40), r.normal(45, 0.01, 40)))]
    want = set()
    for i in range(n):
        d = haversine(x[i], y[i], x, y)
        want |= {("near", *sorted((ids[i], ids[j]))) for j in np.flatnonzero(d <= 120) if j != i}
    for k, g in areas:
        for j in np.flatnonzero(strictly_inside(x, y, edges_of(decode(g)))):
            want.add(("inside", ids[j], k))
    got = near_and_inside(table(spark, [(i, point(a, b)) for i, a, b in zip(ids, x, y)]), 120.0, table(spark, areas), rows_per_tile)
    assert pairs(got) == want


def test_boundary_holes_and_pieces(spark):
    two = encode("MULTIPOLYGON", [[[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]], [[(8.0, 8.0), (9.0, 8.0), (9.0, 9.0), (8.0, 8.0)]]])
    pts = {"in": (0.2, 0.2), "hole": (0.7, 0.7), "edge": (0, 1), "corner": (2, 2), "rim": (0.5, 0.7), "piece": (8.9, 8.5), "out": (3, 3)}
    got = near_and_inside(table(spark, [(k, point(*p)) for k, p in pts.items()]), None, table(spark, [("z1", area(SQUARE, HOLE)), ("z2", two)]))
    assert pairs(got) == {("inside", "in", "z1"), ("inside", "piece", "z2")}


def test_antimeridian_and_poles(spark):
    got = near_and_inside(table(spark, [("a", point(179.9999, 10)), ("b", point(-179.9999, 10)), ("c", point(0, 89.9999)), ("d", point(180, 89.9999)), ("e", point(170, 10))]), 120.0)
    assert pairs(got) == {("near", "a", "b"), ("near", "c", "d")}


def test_nulls_repeats_and_ties(spark):
    rows = [("a", point(1, 1)), ("a", point(1, 1)), ("b", point(1, 1)), (None, point(1, 1)), ("c", None), ("d", b""), ("e", b"junk"), ("f", area(SQUARE))]
    areas = [("z", area(SQUARE)), ("z", area(SQUARE)), (None, area(SQUARE)), ("y", None), ("x", point(1, 1))]
    got = near_and_inside(table(spark, rows), 120.0, table(spark, areas))
    assert pairs(got) == {("near", "a", "b"), ("inside", "a", "z"), ("inside", "b", "z")}


def test_empty_tables(spark):
    assert near_and_inside(table(spark, []), 120.0, table(spark, [])).count() == 0
    assert near_and_inside(table(spark, [("a", point(1, 1))]), 120.0, table(spark, [])).count() == 0
    assert near_and_inside(table(spark, []), 120.0, table(spark, [("z", area(SQUARE))])).count() == 0
