import numpy as np
import pytest

from cartoloom.geo import kernels as K
from cartoloom.geo.sphere import distance, geodesic, haversine
from cartoloom.geo.wkb import Shape, decode, encode
from cartoloom.operators import spatial as S
from cartoloom.plans.intent import answer, parse
from cartoloom.sources import geojson
from cartoloom.sources.views import NAME_COLUMNS

SPHERE = S.Measure(model="sphere")
RAW = S.Measure(model="sphere", prefilter=False)


def names(**k):
    return [k.get(c) for c in NAME_COLUMNS]


def fields(extra):
    return "id string, " + ", ".join(f"{c} string" for c in NAME_COLUMNS) + ", " + extra + ", geometry binary"


def pt(x, y):
    return encode("POINT", [[[(x, y)]]])


def ring(x, y, r):
    p = [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)]
    return encode("POLYGON", [[p]])


@pytest.fixture(scope="module")
def views(spark):
    r = np.random.default_rng(2)
    infra = [(f"i{k}", *names(name=f"n{k}"), "transit", "bus_stop" if k % 3 else "parking", k, pt(10 + r.normal(0, 0.05), 45 + r.normal(0, 0.05))) for k in range(300)]
    infra.append(("line", *names(), "transit", "parking", 1, encode("LINESTRING", [[[(10.0, 45.0), (10.001, 45.001)]]])))
    infra.append(("cut", *names(), "transit", "parking", 1, encode("LINESTRING", [[[(10.0, 45.0), (10.5, 45.0)]]])))
    infra.append(("none", *names(), "transit", "parking", 1, None))
    div = [
        ("d1", *names(name="Gröden", name_fr="Grodene"), "XX", "locality", "town", 8, None, pt(10.0, 45.0)),
        ("d2", *names(name="Grodenheim"), "XX", "locality", "town", 8, 5, pt(10.2, 45.0)),
        ("d3", *names(name="GRODEN"), "XX", "county", "x", 8, 100, pt(10.0, 45.1)),
        ("d4", *names(name=None), "XX", "locality", "town", 8, 5, None),
    ]
    area = [
        ("a1", "d1", *names(name="gröden"), "XX", "locality", "land", True, True, ring(10.0, 45.0, 0.05)),
        ("a2", "d1", *names(name="x"), "XX", "locality", "maritime", False, True, ring(10.0, 45.0, 0.5)),
        ("a3", "d1", *names(name="y"), "XX", "locality", "land", True, True, ring(10.0, 45.0, 0.01)),
        ("a4", "d3", *names(name="L'Ö"), "XX", "country", "land", True, True, ring(10.1, 45.1, 0.1)),
    ]
    water = [
        ("w1", *names(name="Río Tavé"), "river", "river", False, False, encode("LINESTRING", [[[(9.9, 45.0), (10.0, 45.0)]]])),
        ("w2", *names(name="Tave"), "river", "stream", False, False, encode("LINESTRING", [[[(10.0, 45.0), (10.1, 45.02)]]])),
        ("w3", *names(name="Tave lake"), "lake", "lake", False, False, ring(10.3, 45.0, 0.02)),
    ]
    places = [(f"p{k}", f"n{k}", "pizza", ["food", "restaurant", "pizza"], pt(10 + 0.01 * k, 45.0)) for k in range(10)]
    places.append(("px", None, "bar", None, pt(10, 45)))
    return {
        "infrastructures": spark.createDataFrame(infra, fields("subtype string, class string, level int")),
        "divisions": spark.createDataFrame(div, fields("country string, subtype string, class string, admin_level int, population int")),
        "division_areas": spark.createDataFrame(area, "id string, division_id string, " + fields("country string, subtype string, class string, is_land boolean, is_territorial boolean")[11:]),
        "water": spark.createDataFrame(water, fields("subtype string, class string, is_salt boolean, is_intermittent boolean")),
        "places": spark.createDataFrame(places, "id string, name string, category string, category_hierarchy array<string>, geometry binary"),
    }


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_directions_cover_everything(views):
    a = [ids(S.direction(views, "groden", "transit", "parking", d, SPHERE)) for d in S.SECTORS]
    near = ids(S.proximity(views, "groden", "transit", "parking", 100_000.0, SPHERE))
    assert sorted(x for part in a for x in part) == near  # two references, listed for each


def test_prefilter_changes_nothing(views):
    for run in (
        lambda m: S.proximity(views, "Gröden", "transit", "bus_stop", 3000.0, m),
        lambda m: S.along(views, "tave", "transit", "bus_stop", 1000.0, m),
        lambda m: S.area_distance(views, "Tave lake", "transit", "bus_stop", 20_000.0, m),
        lambda m: S.center(views, "gröden", "transit", "bus_stop", m),
        lambda m: S.bordering(views, "L'Ö", 20_000.0, m),
    ):
        got = ids(run(SPHERE))
        assert got == ids(run(RAW)) and got


def test_banks_are_disjoint(views):
    left = set(ids(S.left_right_bank(views, "TAVE", "transit", "bus_stop", 8000.0, 1, SPHERE)))
    right = set(ids(S.left_right_bank(views, "TAVE", "transit", "bus_stop", 8000.0, -1, SPHERE)))
    near = set(ids(S.along(views, "Tave", "transit", "bus_stop", 8000.0, SPHERE)))
    assert left and right and not left & right and left | right == near


def test_periphery_is_part_of_containment(views):
    inside = ids(S.containment(views, "Gröden", "transit", "parking"))
    edge = ids(S.periphery(views, "Gröden", "transit", "parking", 1500.0, SPHERE))
    assert "line" in inside and "cut" not in inside and "none" not in inside
    assert edge and set(edge) < set(inside)


def test_band_in_direction(views):
    d = set(ids(S.direction_distance(views, "Gröden", "transit", "bus_stop", "north", 3000.0, SPHERE)))
    assert d and d <= set(ids(S.direction(views, "Gröden", "transit", "bus_stop", "north", SPHERE)))
    assert S.band(500) == (300, 700) and S.band(100_000) == (90_000, 110_000) and S.center_radius(1e3) == 300 and S.center_radius(1e12) == 5000


def test_show_division_and_cities(views):
    assert ids(S.show_division(views, "grodene")) == ["a1", "d1"]
    assert ids(S.show_division(views, "groden")) == ["a4", "d3"]  # the most populous of that name
    assert ids(S.city_direction(views, "Grodenheim", "west", SPHERE)) == ["d1"]
    got = S.city_direction(views, "Grodenheim", "west", SPHERE).first()
    assert bytes(got["geometry"]) == ring(10.0, 45.0, 0.05)
    assert ids(S.show_division(views, "nowhere")) == []


def test_places(views):
    assert ids(S.places_containment(views, "gröden", "restaurant")) == ["p0", "p1", "p2", "p3", "p4"]
    assert ids(S.places_proximity(views, "grodene", "pizza", 1000.0)) == ["p0", "p1"]
    assert ids(S.places_direction(views, "grodene", "pizza", "west")) == []


def test_measures():
    assert abs(geodesic(0, 0, 1, 0) - 111319.49) < 0.01 and abs(geodesic(0, 0, 0, 1) - 110574.39) < 0.01
    assert geodesic(5, 5, 5, 5) == 0 and np.isfinite(geodesic(0, 0, 180, 0.1))
    assert abs(geodesic(2.35, 48.85, -3.7, 40.4) / haversine(2.35, 48.85, -3.7, 40.4) - 1) < 0.005
    assert distance(1, 50, 2, 50, "sphere", "swapped") > 1.5 * distance(1, 50, 2, 50, "sphere")
    b = S.azimuth(0, 0, np.array([0.0, 1, 0, -1, 0]), np.array([1.0, 0, -1, 0, 0]))
    assert b[:4].tolist() == [0, 90, 180, 270] and np.isnan(b[4])
    edges = np.array([45.0, 135, 225, 315, 0])
    assert [S.in_sector(edges, d).tolist() for d in ("north", "east", "south", "west")] == [
        [False, False, False, True, True], [True, True, False, False, False], [False, True, True, False, False], [False, False, True, True, False],
    ]


def test_kernels():
    square = decode(encode("POLYGON", [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0)]]]))
    assert K.planar_area(square) == 12 and K.centroid(square) == (2, 2)
    line = K.segments_of(decode(encode("LINESTRING", [[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0)]]])))
    f = K.locate(line, np.array([1.0, 3.0]), np.array([1.0, 1.0]))
    assert f.tolist() == [0.25, 0.75]
    x, y = K.interpolate(line, f)
    assert x.tolist() == [1, 2] and y.tolist() == [0, 1]
    assert K.side_of(line, np.array([1.0, 1.0, 1.0]), np.array([0.5, -0.5, 0.0])).tolist() == [1, -1, 0]
    one = decode(encode("LINESTRING", [[[(0.0, 1.0), (4.0, 1.0)]]]))
    two = decode(encode("LINESTRING", [[[(2.0, 0.0), (2.0, 3.0)]]]))
    assert K.closest_point(one, two) == (2, 1)
    assert K.within(decode(encode("POINT", [[[(0.5, 0.5)]]])), square) and not K.within(decode(encode("POINT", [[[(2.0, 2.0)]]])), square)
    assert not K.within(decode(encode("LINESTRING", [[[(0.5, 2.0), (3.5, 2.0)]]])), square)  # across the hole


def test_every_phrase_is_understood(views):
    from cartoloom.plans import phrases as P

    values = {"category": "bus stops", "place": "Lyon", "de_place": "de Lyon", "a_place": "à Lyon", "feature": "Tave", "distance": "1.5km", "direction": "north", "side": "left", "se_trouve": "se trouve"}
    french = values | {"category": "arrêts de bus", "direction": "au nord", "side": "gauche", "distance": "1,5km"}
    for template, lang, _, phrase in P.phrases():
        own = french if lang == "fr" else values
        if template.startswith("places_"):
            own = own | {"category": "restaurants"}
        got = parse(phrase.format(**own))
        assert got is not None and got.template == template, (template, phrase, got)
        assert got.params.get("place", "Lyon") == "Lyon" and got.params.get("distance_m", 1500) == 1500
    assert parse("what time is it") is None
    assert ids(answer(views, "parkings près de Grodene")) == ids(S.proximity(views, "Grodene", "transit", "parking"))


def test_geojson(views):
    rows = views["infrastructures"].where("id in ('line', 'none', 'i1')").select("id", "name", "geometry").orderBy("id")
    got = geojson.feature_collection(rows)["features"]
    assert [f["geometry"] and f["geometry"]["type"] for f in got] == ["Point", "LineString", None]
    assert got[1]["properties"] == {"id": "line", "name": None} and got[1]["geometry"]["coordinates"] == [[10.0, 45.0], [10.001, 45.001]]


def test_sampled_parameters_have_answers(views):
    from cartoloom.plans import sampling as G

    d = views["divisions"].select("id", "name", "country", "subtype", "geometry")
    e = views["infrastructures"].selectExpr("id", "'XX' as country", "subtype", "class", "geometry")
    got = G.sample_relations(d, e, 5).collect()
    assert {r["template"] for r in got} == {"proximity", "direction", "direction_distance", "city_direction", "city_direction_distance", "show_division"}
    for r in got:
        if r["template"] == "proximity":
            assert ids(S.proximity(views, r["place"], r["subtype"], r["class"]))
        if r["template"] == "direction":
            assert ids(S.direction(views, r["place"], r["subtype"], r["class"], r["direction"]))
        if r["template"] == "city_direction":
            assert ids(S.city_direction(views, r["place"], r["direction"]))
    got = G.sample_inside(views["division_areas"], views["infrastructures"].select("id", "subtype", "class", "geometry"), 5).collect()
    assert {"containment", "center"} <= {r["template"] for r in got}
    for r in got:
        run = {"containment": S.containment, "center": S.center, "periphery": S.periphery}[r["template"]]
        assert ids(run(views, r["place"], r["subtype"], r["class"]))


def test_relations_are_sampled_from_all_features(spark):
    """One feature near one of 40 towns, among 3000 that are too far: neither is left to chance."""
    from cartoloom.plans import sampling as G

    d = spark.createDataFrame([(f"t{k}", f"town {k}", "XX", "locality", pt(10 + 0.2 * k, 45.0)) for k in range(40)], "id string, name string, country string, subtype string, geometry binary")
    far = [(f"f{k}", "XX", "transit", "bus_stop", pt(10 + 0.2 * (k % 40), 45.3 + 1e-4 * k)) for k in range(3000)]
    e = spark.createDataFrame([*far, ("near", "XX", "transit", "parking", pt(13.4, 45.01))], "id string, country string, subtype string, class string, geometry binary")
    got = [r for r in G.sample_relations(d, e, 2).collect() if r["template"] == "proximity"]
    assert [(r["place"], r["class"]) for r in got] == [("town 17", "parking")]
    n = {t: 0 for t in (*G.NEAR, *G.CITIES, G.SHOWN)}
    for r in G.sample_relations(d, e, 2).collect():
        n[r["template"]] += 1
    assert n == {"proximity": 1, "direction": 2, "direction_distance": 2, "city_direction": 2, "city_direction_distance": 2, "show_division": 2}


def test_areas_without_a_point_use_no_quota(spark):
    """Of 30 areas three have a point; one has 500, of which one lies in the centre and one near the border."""
    from cartoloom.plans import sampling as G

    a = spark.createDataFrame([(f"a{k}", f"area {k}", "XX", "locality", True, ring(10 + 0.5 * k, 45.0, 0.2)) for k in range(30)], "id string, name string, country string, subtype string, is_land boolean, geometry binary")
    many = [(f"m{k}", "transit", "bus_stop", pt(13.5 + 0.1, 45.0 + 1e-5 * k)) for k in range(498)]
    few = [("c", "transit", "parking", pt(13.5, 45.0)), ("b", "transit", "ferry_terminal", pt(13.5, 45.199)), ("x", "power", "tower", pt(15.1, 45.1)), ("y", "power", "tower", pt(20.1, 45.1))]
    e = spark.createDataFrame(many + few, "id string, subtype string, class string, geometry binary")
    got = {(r["template"], r["place"], r["class"]) for r in G.sample_inside(a, e, 5).collect()}
    assert {(t, p) for t, p, _ in got if t == "containment"} == {("containment", "area 7"), ("containment", "area 10"), ("containment", "area 20")}
    assert {x for x in got if x[0] != "containment"} == {("center", "area 7", "parking"), ("periphery", "area 7", "ferry_terminal")}
    groups, G.GROUP = G.GROUP, 20
    try:
        assert {(r["template"], r["place"], r["class"]) for r in G.sample_inside(a, e, 5).collect()} == got
    finally:
        G.GROUP = groups


def test_area_on_the_spheroid_and_intersections():
    ring = lambda x, y, d: np.array([[x, y], [x + d, y], [x + d, y + d], [x, y + d], [x, y]])
    square = Shape("POLYGON", (ring(10.0, 45.0, 1.0),), (0,))
    # a degree cell at 45 degrees north on WGS84 has 8,686.6 square kilometres between its parallels
    e2 = 0.0066943799901413165
    q = lambda p: (1 - e2) * (np.sin(p) / (1 - e2 * np.sin(p) ** 2) + np.arctanh(np.sqrt(e2) * np.sin(p)) / np.sqrt(e2))
    exact = 6378137.0**2 / 2 * np.radians(1.0) * (q(np.radians(46.0)) - q(np.radians(45.0)))
    assert abs(K.spheroid_area(square) / exact - 1) < 2e-4
    line = lambda *p: Shape("LINESTRING", (np.array(p, dtype=float),), (0,))
    assert K.intersects(square, line((9.5, 45.5), (11.5, 45.5))) and K.intersects(line((9.5, 45.5), (11.5, 45.5)), square)
    assert not K.intersects(square, line((9.0, 44.0), (9.5, 46.5))) and K.intersects(square, line((10.4, 45.4), (10.6, 45.6)))
    assert K.intersects(square, Shape("POLYGON", (ring(9.0, 44.0, 3.0),), (0,))) and not K.intersects(square, Shape("POLYGON", (ring(12.0, 45.0, 1.0),), (0,)))
    assert K.intersects(square, Shape("POINT", (np.array([[10.5, 45.5]]),), (0,))) and K.intersects(square, Shape("POINT", (np.array([[10.0, 45.5]]),), (0,)))


def test_line_strings_in_every_encoding(spark):
    import struct

    flat = struct.pack("<BII4d", 1, 2, 2, 0, 0, 1, 1)
    rows = {
        "little": flat, "big": struct.pack(">BII4d", 0, 2, 2, 0, 0, 1, 1), "z": struct.pack("<BII6d", 1, 1002, 2, 0, 0, 5, 1, 1, 5),
        "extended z": struct.pack("<BII6d", 1, 0x80000002, 2, 0, 0, 5, 1, 1, 5), "srid": struct.pack("<BIII4d", 1, 0x20000002, 4326, 2, 0, 0, 1, 1),
        "point": struct.pack("<BI2d", 1, 1, 0, 0), "multi": struct.pack("<BII", 1, 5, 1) + flat, "none": None,
    }
    df = spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, v in rows.items()], "k string, geometry binary")
    assert {r["k"] for r in df.where(S.is_line("geometry")).collect()} == {"little", "big", "z", "extended z", "srid"}


def test_equally_near_lines(spark, monkeypatch):
    """The first line by id wins a tie, with one block of lines as with many."""
    lines = [(f"w{i}", "Twin", "river", "LINESTRING", [(-1.0, 0.0), (1.0, 0.0)] if i % 2 else [(1.0, 0.0), (-1.0, 0.0)]) for i in range(4)]
    wkb = lambda k, p: bytearray(encode(k, [[p]]) if k != "LINESTRING" else encode(k, [[p]]))
    names = ", ".join(f"{c} string" for c in S.SEARCH_COLUMNS)
    water = spark.createDataFrame([(i, n, *[None] * (len(S.SEARCH_COLUMNS) - 1), c, wkb(k, p)) for i, n, c, k, p in lines], f"id string, {names}, class string, geometry binary")
    infra = spark.createDataFrame([(f"e{i}", "x", "transit", "parking", wkb("POINT", [(0.1 * i, 0.01)])) for i in range(5)], "id string, name string, subtype string, class string, geometry binary")
    v = {"water": water, "infrastructures": infra}
    got = []
    for rows in (5000, 1):
        monkeypatch.setattr(S, "BLOCK_ROWS", rows)
        got.append([sorted(r["id"] for r in S.left_right_bank(v, "twin", "transit", "parking", side_sign=s).collect()) for s in (1, -1)])
    assert got[0] == got[1] == [[], [f"e{i}" for i in range(5)]]
