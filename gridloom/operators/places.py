"""Systems and weather locations by name and by distance."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import geo
from gridloom.functions.numeric import known
from gridloom.operators.joins import fan_out_join
from gridloom.operators.rings import RingIndex

# Cell sizes in degrees, each half the one before; the first holds the globe, the last
# is about 300 m high, little more than the slack below.
CELL_SIZES = [360.0 / 2**k for k in range(18)]

# Two locations at the same rounded distance may differ by this much, plus slack
# for the formula's error.
ROUNDING_SLACK_KM = 0.2

# Locations that go to all tasks as an index, some 10 MB; the table is counted first.
MOST_INDEXED = 100_000


def pv_with_missing_location(systems: DataFrame) -> DataFrame:
    """PV systems without coordinates. ``_`` is a wildcard here: ``pvx1`` matches too."""
    return systems.where(F.col("sid").like("pv_%") & (F.col("lat").isNull() | F.col("lon").isNull()))


def random_pv_systems(systems: DataFrame, autoupdate: int = 1, limit: int | None = None, seed: int | None = None) -> DataFrame:
    """PV systems in random order; with a ``seed`` the order repeats."""
    chosen = systems.where(F.col("sid").startswith("pv_") & (F.col("autoupdate") == autoupdate))
    order = F.rand() if seed is None else F.xxhash64("sid", F.lit(seed))
    chosen = chosen.select("sid", "qual", "freq", "lag").orderBy(order, "sid")
    return chosen if limit is None else chosen.limit(limit)


def weather_locations(locations: DataFrame, country: str = "NL", active: int = 1) -> DataFrame:
    return locations.where((F.col("country") == country) & (F.col("active") == active)).select(
        F.col("input_city").alias("city"), "lat", "lon", "country"
    )


def lookup_coordinates(names: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinates per name; names the gazetteer does not hold keep nulls."""
    known = gazetteer.select(F.col("regionInput").alias("name"), "lat", "lon")
    return names.join(known, "name", "left")


def unresolved_names(names: DataFrame, gazetteer: DataFrame) -> DataFrame:
    return names.join(gazetteer.select(F.col("regionInput").alias("name")), "name", "left_anti").distinct()


def _eligible(systems: DataFrame, quality: float, freq: int | None, lag_systems: float | None) -> DataFrame:
    systems = systems.where((F.col("qual") > quality) & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if freq is not None:
        systems = systems.where(F.col("freq") <= freq)
    if lag_systems is not None:
        systems = systems.where(F.col("lagSystems") <= lag_systems)
    return systems


def systems_near_location(
    systems: DataFrame,
    location: tuple[float, float],
    radius: float = 15.0,
    quality: float = 0.75,
    freq: int | None = None,
    lag_systems: float | None = None,
) -> DataFrame:
    """Systems within ``radius`` km of one location, nearest first."""
    distance = geo.great_circle_km(F.lit(float(location[0])), F.lit(float(location[1])), F.col("lat"), F.col("lon"))
    return (
        _eligible(systems, quality, freq, lag_systems)
        .select("sid", "lat", "lon", "region", distance.alias("distance"))
        .where(F.col("distance") < radius)
        .orderBy("distance", "sid")
    )


def systems_near_sites(
    sites: DataFrame,
    systems: DataFrame,
    radius: float = 15.0,
    quality: float = 0.75,
    freq: int | None = None,
    lag_systems: float | None = None,
) -> DataFrame:
    """The same for many sites (``site, lat, lon``): an equi-join on cells, then the exact distance.

    Cells are at least the radius high; by the areas a site meets some four systems for each one in reach.
    Sines and cosines are taken once for each site and system; a pair is judged by a product of
    vectors, and the distance itself is taken of the pairs that stay.
    """
    size = F.lit(min((s for s in CELL_SIZES if s * geo.KM_PER_DEGREE >= radius), default=360.0))
    rows, cols = geo.lat_cell(F.col("lat"), size), geo.lon_cell(F.col("lon"), size)
    placed = _eligible(systems, quality, freq, lag_systems).select(
        "sid", "lat", "lon", "region", rows.alias("__row"), cols.alias("__col"),
        *[c.alias(name) for name, c in geo.turned("__its_", F.col("lat"), F.col("lon")).items()],
    )
    # The cells are those of a slightly larger circle; the distance below is exact.
    reach = F.lit(radius * 1.01)
    wanted = (
        sites.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select("site", F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
        .withColumns(geo.turned("__own_", F.col("__lat"), F.col("__lon")))
        .withColumn("__row", F.explode(geo.covering_lat_cells(F.col("__lat"), reach, size)))
        .withColumn("__col", F.explode(geo.covering_lon_cells(F.col("__lat"), F.col("__lon"), reach, size)))
        .drop("__lat", "__lon")
    )
    own, its = ({c: F.col(c) for c in geo.turned(p, F.lit(0.0), F.lit(0.0))} for p in ("__own_", "__its_"))
    return (
        fan_out_join(wanted, placed, ["__row", "__col"], by=["site"], count_rows=True)
        .where(geo.turned_below(own, its, radius))
        .select("site", "sid", "lat", "lon", "region", geo.turned_km(own, its).alias("distance"))
    )


def named_sites(sites: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Sites given by place (``site, name``) as ``site, lat, lon``; unknown names keep nulls."""
    return lookup_coordinates(sites, gazetteer).select("site", "lat", "lon")


def _diagonal(size: float) -> float:
    """Longest distance in a cell: degrees are longest at 111.7 km, a diagonal has sqrt(2) sides."""
    return size * 111.7 * 1.4143 + ROUNDING_SLACK_KM


def _in_cells(df: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Rows with the cells they lie in, one row per level."""
    sizes = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(CELL_SIZES[k]).alias("size")) for k in levels])
    size = F.col("__level.size")
    return df.withColumn("__level", F.explode(sizes)).select(
        *df.columns,
        F.col("__level.k").alias("__k"),
        geo.lat_cell(F.col("lat"), size).alias("__row"),
        geo.lon_cell(F.col("lon"), size).alias("__col"),
    )


def pairs_in_cells(
    spots: DataFrame, locations: DataFrame, number: int, levels: Sequence[int], otherwise: float
) -> DataFrame:
    """Locations worth a distance for every spot (``lat, lon``), and whether the search is known to suffice.

    Locations are counted per cell at the given levels; a spot takes the smallest own cell that
    holds ``number`` of them, whose diagonal bounds the search (``__enough``). Where no own cell
    does, cells of the first level within ``otherwise`` km are searched. A crowded cell's spots are
    dealt over shares.
    """
    placed = _in_cells(locations, levels)
    cell = ["__k", "__row", "__col"]
    full = placed.groupBy(*cell).count().where(F.col("count") >= number).select(*cell)
    own = _in_cells(spots, levels).join(full.withColumn("__full", F.lit(True)), cell, "left")
    own = own.groupBy("lat", "lon").agg(F.max(F.when(F.col("__full"), F.col("__k"))).alias("__own"))
    level = own.withColumn("__k", F.coalesce("__own", F.lit(levels[0])))
    sizes = F.array(*[F.lit(s) for s in CELL_SIZES])
    diagonals = F.array(*[F.lit(_diagonal(s)) for s in CELL_SIZES])
    reach = F.when(F.col("__own").isNull(), F.lit(otherwise)).otherwise(F.element_at(diagonals, F.col("__k") + 1))
    search = (
        level.select(
            F.col("lat").alias("__lat"), F.col("lon").alias("__lon"), "__k", F.col("__own").isNotNull().alias("__enough"),
            F.element_at(sizes, F.col("__k") + 1).alias("__size"), F.least(reach, F.lit(20_100.0)).alias("__reach"),
        )
        .withColumn("__row", F.explode(geo.covering_lat_cells(F.col("__lat"), F.col("__reach"), F.col("__size"))))
        .withColumn(
            "__col", F.explode(geo.covering_lon_cells(F.col("__lat"), F.col("__lon"), F.col("__reach"), F.col("__size")))
        )
        .drop("__size", "__reach")
    )
    distance = F.round(geo.geodesic_km(F.col("__lat"), F.col("__lon"), F.col("lat"), F.col("lon")), 1)
    pairs = fan_out_join(search, placed, cell, by=["__lat", "__lon"])
    return pairs.select("__lat", "__lon", "__enough", F.col("city").alias("input_city"), distance.alias("distance"))


def bounded_levels(threshold: float) -> list[int]:
    """Levels whose cells are no wider than the threshold; the last one where none is."""
    levels = range(len(CELL_SIZES))
    return [k for k in levels if _diagonal(CELL_SIZES[k]) <= threshold] or [levels[-1]]


def _nearest_in_cells(
    spots: DataFrame, locations: DataFrame, number: int, levels: Sequence[int], otherwise: float
) -> DataFrame:
    """The first ``number`` of the pairs of every spot, ranked."""
    pairs = pairs_in_cells(spots, locations, number, levels, otherwise)
    order = Window.partitionBy("__lat", "__lon").orderBy("distance", "input_city")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= number)


def _nearest_by_cells(sites: DataFrame, locations: DataFrame, number: int, threshold: float) -> DataFrame:
    """The same for locations of any number.

    No site meets every location. The search ends at the threshold: a site that has no cell of its
    own with enough locations looks at cells within the threshold only. Only sites that have some
    location in range, but fewer than ``number``, look further, by larger cells.
    """
    broken = F.raise_error(F.lit("weather location without coordinates")).cast("double")
    locations = locations.select(
        "city", F.coalesce(known(F.col("lat")), broken).alias("lat"), F.coalesce(known(F.col("lon")), broken).alias("lon")
    )
    # Of locations at one spot only the first by name can be among the nearest.
    at_spot = Window.partitionBy("lat", "lon").orderBy("city")
    locations = locations.withColumn("__n", F.row_number().over(at_spot)).where(F.col("__n") <= number).drop("__n")
    sites = sites.withColumn("lat", known(F.col("lat"))).withColumn("lon", known(F.col("lon")))
    # Sites that share coordinates share the search.
    spots = sites.select("lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).distinct()
    ranked = _nearest_in_cells(spots, locations, number, bounded_levels(threshold), threshold + ROUNDING_SLACK_KM)
    spot = Window.partitionBy("__lat", "__lon")
    ranked = ranked.withColumn("__nearest", F.min("distance").over(spot)).where(F.col("__nearest") < threshold)
    if number > 1:
        close = F.count_if(F.col("distance") <= threshold).over(spot) >= number
        ranked = ranked.withColumn("__enough", F.col("__enough") | close)
        short = ranked.where(~F.col("__enough")).select(F.col("__lat").alias("lat"), F.col("__lon").alias("lon")).distinct()
        wide = _nearest_in_cells(short, locations, number, range(len(CELL_SIZES)), 20_100.0)
        ranked = ranked.where("__enough").drop("__nearest").unionByName(wide)
    ranked = ranked.select("__lat", "__lon", "input_city", "distance", "rank")
    located = F.col("__lat").isNotNull() & F.col("__lon").isNotNull()
    flag = F.when(F.col("input_city").isNotNull(), F.lit(False)).when(located, F.lit(True))
    return (
        sites.withColumnsRenamed({"lat": "__lat", "lon": "__lon"})
        .join(ranked, ["__lat", "__lon"], "left")
        .withColumn("out_of_range", flag)
        .drop("__lat", "__lon")
    )


def candidate_locations(index: Broadcast, number: int, threshold: float) -> Callable:
    """A function of lat and lon: the locations that can be among the nearest, as lists side by side."""

    @F.pandas_udf("struct<city: array<string>, lat: array<double>, lon: array<double>>")
    def near(lat: pd.Series, lon: pd.Series) -> pd.DataFrame:
        rings, cities, lats, lons = index.value
        here = np.stack([lat.to_numpy(np.float64, na_value=np.nan), lon.to_numpy(np.float64, na_value=np.nan)], axis=1)
        located = ~np.isnan(here).any(axis=1)
        spots, of_row = np.unique(here[located], axis=0, return_inverse=True)
        spot, place = rings.nearest(spots[:, 0], spots[:, 1], number, threshold)
        cuts = np.searchsorted(spot, np.arange(len(spots) + 1))
        parts = [np.zeros(0, np.int64)] * len(here)
        for row, s in zip(np.flatnonzero(located).tolist(), of_row.ravel().tolist(), strict=True):
            parts[row] = place[cuts[s] : cuts[s + 1]]
        return pd.DataFrame({n: [v[p] for p in parts] for n, v in (("city", cities), ("lat", lats), ("lon", lons))})

    return near


def _indexed(locations: DataFrame, number: int) -> Broadcast | None:
    """The locations as an index for all tasks; nothing where there are too many for one."""
    # Of locations at one spot only the first by name can be among the nearest.
    at_spot = Window.partitionBy("lat", "lon").orderBy(F.asc_nulls_last("city"))
    first = locations.select("city", "lat", "lon", F.row_number().over(at_spot).alias("__n")).where(F.col("__n") <= number)
    held = first.drop("__n").limit(MOST_INDEXED + 1).toPandas()
    if len(held) > MOST_INDEXED:
        return None
    if held[["lat", "lon"]].isna().to_numpy().any():
        raise ValueError("weather location without coordinates")
    held = held.sort_values(["lat", "lon", "city"])
    lat, lon = held["lat"].to_numpy(np.float64), held["lon"].to_numpy(np.float64)
    index = RingIndex(lat, lon), held["city"].to_numpy(object), lat, lon
    return locations.sparkSession.sparkContext.broadcast(index)


def nearest_locations(
    sites: DataFrame, locations: DataFrame, number: int = 1, threshold: float = 150.0
) -> DataFrame:
    """The ``number`` nearest locations (``city, lat, lon``) of every site (``site, lat, lon``).

    Distances are geodesic and rounded to 0.1 km; equal ones are ordered by city. A site whose
    nearest location is not below ``threshold`` has one row, ``out_of_range``, without location; one
    without coordinates (null or NaN) has such a row with ``out_of_range`` null. A location without
    coordinates stops the job.

    Up to ``MOST_INDEXED`` locations, ``number`` at one spot at most, go to all tasks as an index, and every site is answered where it
    is, by a search in growing rings of cells (``rings``): nothing is shuffled, and a site meets about
    as many locations as it asks for. More locations than that are joined by cells.
    """
    index = _indexed(locations, number)
    if index is None:
        return _nearest_by_cells(sites, locations, number, threshold)
    lat, lon = known(F.col("lat")), known(F.col("lon"))
    columns = [c for c in sites.columns if c not in ("lat", "lon")]
    found = sites.select(*columns, lat.cast("double").alias("__lat"), lon.cast("double").alias("__lon"))
    found = found.withColumn("__near", candidate_locations(index, number, threshold)("__lat", "__lon"))

    def measured(place: Column) -> Column:
        km = F.round(geo.geodesic_km(F.col("__lat"), F.col("__lon"), place["lat"], place["lon"]), 1)
        return F.struct(km.alias("distance"), place["city"].alias("input_city"))

    pairs = F.arrays_zip(F.col("__near.city").alias("city"), F.col("__near.lat").alias("lat"), F.col("__near.lon").alias("lon"))
    found = found.withColumn("__ranked", F.slice(F.sort_array(F.transform(pairs, measured)), 1, number))
    near = F.get("__ranked", F.lit(0))["distance"] < threshold
    found = found.withColumn("__ranked", F.when(near, F.col("__ranked")))
    located = F.col("__lat").isNotNull() & F.col("__lon").isNotNull()
    return found.select(*columns, located.alias("__located"), F.posexplode_outer("__ranked").alias("__place", "__found")).select(
        *columns, "__found.input_city", "__found.distance", (F.col("__place") + 1).alias("rank"),
        F.when(F.col("__found").isNotNull(), F.lit(False)).when(F.col("__located"), F.lit(True)).alias("out_of_range"),
    )


def attach_distance(weather: DataFrame, nearest: DataFrame, number: int) -> DataFrame:
    """Give each site the series of its locations: with city and distance when there are several."""
    members = nearest.select("site", "input_city", "distance")
    joined = fan_out_join(weather, members, ["input_city"], by=["datetime"])
    return joined.drop("input_city", "distance") if number == 1 else joined
