import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import geo
from gridloom.operators import places, rings

FR = [("A", 42.3, 2.2), ("B", 43.3, 2.6), ("C", 42.5, 2.6), ("D", 42.3, 2.6), ("E", 42.3, 2.8)]
NL = [("Rotterdam", 51.926517, 4.462456), ("Amsterdam", 52.377956, 4.897070)]


def located(spark, rows):
    return spark.createDataFrame(rows, "city string, lat double, lon double")


def site(spark, *points):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "site int, lat double, lon double")


@pytest.mark.parametrize("number, expected", [(1, [("D", 8.2)]), (2, [("D", 8.2), ("E", 8.2)])])
def test_nearest_with_a_tie(spark, number, expected):
    found = places.nearest_locations(site(spark, (42.3, 2.7)), located(spark, FR), number).orderBy("rank").collect()
    assert [(r["input_city"], r["distance"]) for r in found] == expected
    assert not any(r["out_of_range"] for r in found)


def test_nearest_is_ellipsoidal(spark):
    found = places.nearest_locations(site(spark, (52.0, 4.7)), located(spark, NL), 2).collect()
    assert {r["input_city"]: r["distance"] for r in found} == {"Rotterdam": 18.3, "Amsterdam": 44.2}


def test_far_sites_are_flagged_and_missing_coordinates_stop(spark):
    far = site(spark, (-30.0, -60.0), (None, 5.0), (float("nan"), 5.0))
    found = {r["site"]: r for r in places.nearest_locations(far, located(spark, NL), 2).collect()}
    assert len(found) == 3 and all(r["input_city"] is None and r["distance"] is None for r in found.values())
    assert [found[i]["out_of_range"] for i in range(3)] == [True, None, None]
    with pytest.raises(Exception, match="without coordinates"):
        places.nearest_locations(site(spark, (52.0, 4.7)), located(spark, [*NL, ("X", None, 5.0)]), 1).collect()
    with pytest.raises(Exception, match="without coordinates"):
        places.nearest_locations(site(spark, (52.0, 4.7)), located(spark, [*NL, ("X", float("nan"), 5.0)]), 1).collect()


def test_fewer_locations_than_asked(spark):
    assert places.nearest_locations(site(spark, (52.0, 4.7)), located(spark, NL), 5).count() == 2


def scattered(seed, n):
    rng = random.Random(seed)
    points = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]
    points += [(52 + rng.gauss(0, 0.3), 5 + rng.gauss(0, 0.3)) for _ in range(n)]
    points += [(rng.uniform(-5, 5), 180 * rng.choice([-1, 1]) + rng.uniform(-0.5, 0.5)) for _ in range(n // 4)]
    points += [(89.9 - rng.random(), rng.uniform(-180, 180)) for _ in range(n // 4)]
    return [(lat, (lon + 180) % 360 - 180) for lat, lon in points]


@pytest.mark.parametrize("threshold", [150.0, 900.0, 25_000.0])
@pytest.mark.parametrize("number", [1, 4])
@pytest.mark.parametrize("most_indexed", [places.MOST_INDEXED, 0])
def test_nearest_equals_all_pairs(spark, monkeypatch, most_indexed, number, threshold):
    monkeypatch.setattr(places, "MOST_INDEXED", most_indexed)
    locations = located(spark, [(f"c{i:04d}", *p) for i, p in enumerate(scattered(1, 150))])
    sites = site(spark, *scattered(2, 120))
    found = places.nearest_locations(sites, locations, number, threshold).select("site", "rank", "input_city", "distance")
    pairs = sites.crossJoin(locations.withColumnsRenamed({"lat": "a", "lon": "o"}))
    pairs = pairs.withColumn("d", F.round(geo.geodesic_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("o")), 1))
    expected = []
    by_site = {}
    for r in pairs.select("site", "city", "d").collect():
        by_site.setdefault(r["site"], []).append((r["d"], r["city"]))
    for s, candidates in by_site.items():
        if min(candidates)[0] >= threshold:
            expected.append((s, None, None, None))
            continue
        expected += [(s, i + 1, c, d) for i, (d, c) in enumerate(sorted(candidates)[:number])]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("sites_at", [(48.0, 5.0), (-33.0, 151.0), (60.0, -30.0)])
def test_far_sites_meet_no_location(spark, sites_at):
    """The number of pairs that are compared, not the names of operators, tells a cross product."""
    rng = random.Random(3)
    near = [(f"c{i:04d}", 52 + rng.random(), 5 + rng.random()) for i in range(300)]
    spots = spark.createDataFrame([(sites_at[0] + rng.random(), sites_at[1] + rng.random()) for _ in range(200)], "lat double, lon double")
    levels = places.bounded_levels(150.0)
    assert places.pairs_in_cells(spots, located(spark, near), 1, levels, 150.2).count() == 0
    inside = spark.createDataFrame([(52 + rng.random(), 5 + rng.random()) for _ in range(200)], "lat double, lon double")
    assert places.pairs_in_cells(inside, located(spark, near), 1, levels, 150.2).count() < 200 * 300 / 4


def test_rings_meet_about_as_many_places_as_asked_for():
    rng = np.random.default_rng(5)
    towns = rng.normal(size=(40, 2)) * [8, 20] + [50, 10]
    places_ = np.concatenate([t + rng.normal(size=(100, 2)) * 0.2 for t in towns] + [rng.uniform([-80, -180], [80, 180], (500, 2))])
    index = rings.RingIndex(places_[:, 0], places_[:, 1])
    spots = np.concatenate([places_[::7] + 0.01, rng.uniform([-89, -180], [89, 180], (500, 2))])
    for number in (1, 3, 10):
        spot, place = index.nearest(spots[:, 0], spots[:, 1], number, 25_000.0)
        per_spot = np.bincount(spot, minlength=len(spots))
        assert per_spot.min() >= number and per_spot.mean() <= 1.5 * number + 3
        km = index.points @ np.stack(rings._on_sphere(spots[:, 0], spots[:, 1]), axis=0).T
        best = np.argsort(-km, axis=0)[:number]
        assert all(set(best[:, i]) <= set(place[spot == i]) for i in range(0, len(spots), 13))
    # Nothing within the threshold: nothing is met.
    assert len(index.nearest(np.array([-89.9]), np.array([0.0]), 3, 10.0)[0]) == 0
    assert len(rings.RingIndex(np.zeros(0), np.zeros(0)).nearest(np.array([1.0]), np.array([1.0]), 3, 10.0)[0]) == 0


def test_rings_of_crowded_places():
    """Cells are as small as places of one region ask for, not as if those were spread over the globe."""
    k = np.arange(5000)
    index = rings.RingIndex(50 + k * 37 % 350 / 100, 3 + k * 53 % 400 / 100)
    spot, _ = index._ring(index.points, 0)
    assert len(spot) < 100 * len(k)


def test_locations_of_one_spot_count_once_for_the_index(spark, monkeypatch):
    monkeypatch.setattr(places, "MOST_INDEXED", 4)
    crowd = [("L%03d" % i, 52.0 + i % 2, 5.0) for i in range(60)]
    held = spark.createDataFrame(crowd, "city string, lat double, lon double")
    index = places._indexed(held, 2)
    assert sorted(index.value[1]) == ["L000", "L001", "L002", "L003"]
    assert places._indexed(held, 3) is None


def test_nearest_shuffles_nothing(spark):
    found = places.nearest_locations(site(spark, *scattered(2, 20)), located(spark, NL), 2)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("radius", [15.0, 400.0])
def test_systems_near_sites_equals_all_pairs(spark, radius):
    rows = [(f"s{i}", *p, "r", 0.9, 5, 1.0) for i, p in enumerate(scattered(3, 150))]
    systems = spark.createDataFrame(
        rows, "sid string, lat double, lon double, region string, qual double, freq int, lagSystems double"
    )
    sites = site(spark, *scattered(4, 120))
    found = places.systems_near_sites(sites, systems, radius).select("site", "sid")
    pairs = sites.crossJoin(systems.withColumnsRenamed({"lat": "a", "lon": "o"}))
    distance = geo.great_circle_km(F.col("lat"), F.col("lon"), F.col("a"), F.col("o"))
    expected = pairs.where(distance < radius).select("site", "sid")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert found.count() > 0


def test_great_circle_of_equal_points_is_a_number(spark):
    points = spark.createDataFrame([(i * 0.013, i * 0.017) for i in range(2000)], "a double, o double")
    km = geo.great_circle_km(F.col("a"), F.col("o"), F.col("a"), F.col("o"))
    assert points.where(F.isnan(km) | ~(km < 1)).count() == 0


def test_wildcard_and_literal_prefixes(spark):
    rows = [("pv_1", None, 5.0, 1), ("pvx1", 52.0, None, 1), ("pv_2", 52.0, 5.0, 1), ("sys", None, None, 1)]
    systems = spark.createDataFrame(rows, "sid string, lat double, lon double, autoupdate int")
    assert {r["sid"] for r in places.pv_with_missing_location(systems).collect()} == {"pv_1", "pvx1"}
    full = systems.withColumns({c: F.lit(1) for c in ("qual", "freq", "lag")})
    assert {r["sid"] for r in places.random_pv_systems(full).collect()} == {"pv_1", "pv_2"}
    assert places.random_pv_systems(full, limit=1, seed=3).count() == 1


def test_locations_at_one_spot(spark):
    crowd = [(f"x{i:03d}", 52.0, 5.0) for i in range(200)] + [("a", 52.1, 5.0)]
    found = places.nearest_locations(site(spark, (52.0, 5.0)), located(spark, crowd), 3).orderBy("rank").collect()
    assert [(r["input_city"], r["distance"]) for r in found] == [("x000", 0.0), ("x001", 0.0), ("x002", 0.0)]


def test_pairs_take_no_sines_of_their_points(spark):
    """Every pair of a site and a system in its cells took five sines and cosines, though most were out of reach."""
    sites = spark.createDataFrame([(1, 52.0, 5.0), (2, float("nan"), 5.0)], "site int, lat double, lon double")
    systems = spark.createDataFrame([("a", 52.0, 5.1, "R", 0.9)], "sid string, lat double, lon double, region string, qual double")
    found = places.systems_near_sites(sites, systems, 15.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join Inner" in line and "ACOS" in line]
    assert joins and not any("RADIANS" in line or "SIN(" in line.replace("ASIN(", "") for line in joins)
    near = found.where("site = 1").collect()
    assert [r["sid"] for r in near] == ["a"]
    km = spark.range(1).select(geo.great_circle_km(F.lit(52.0), F.lit(5.0), F.lit(52.0), F.lit(5.1)).alias("km")).first()["km"]
    assert near[0]["distance"] == km


@pytest.mark.parametrize("radius", [-1.0, 0.0, 1e-4, 0.5, 15.0, 6000.0, 20_015.0, 20_016.0, 30_000.0])
def test_judged_by_vectors_as_by_distance(spark, radius):
    draw = random.Random(3)
    rows = [(52.0, 5.0, 52.0, 5.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 7.0), (float("nan"), 1.0, 2.0, 3.0)]
    for _ in range(500):
        lat, lon = draw.uniform(-89, 89), draw.uniform(-180, 180)
        # Systems about as far north of the site as the radius is long.
        rows.append((lat, lon, lat + math.degrees(radius / 6371.0) * draw.choice([1 - 1e-9, 1.0, 1 + 1e-9, 0.7, 1.3]), lon))
        rows.append((lat, lon, draw.uniform(-90, 90), draw.uniform(-180, 180)))
    points = spark.createDataFrame(rows, "a double, b double, c double, d double")
    first, second = geo.turned("p", F.col("a"), F.col("b")), geo.turned("q", F.col("c"), F.col("d"))
    told = points.select(
        geo.turned_below(first, second, radius).alias("below"),
        (geo.great_circle_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")) < radius).alias("near"),
    )
    assert told.where("not (below <=> near)").count() == 0
