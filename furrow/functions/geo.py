"""Coordinates: UTM and WGS84 by series, CRS texts, dates in file names, affine transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid and the UTM grid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING = 10000000.0
METRES_A_DEGREE = 111320.0
E2 = 2 * FLATTENING - FLATTENING**2
EP2 = E2 / (1 - E2)

#: Marks of projected and of geographic systems in a CRS text.
PROJECTED = ("PROJCS", "PROJCRS", "PROJECTED", "UTM", "TRANSVERSE_MERCATOR", "LAMBERT", "ALBERS", "MERCATOR", "GAUSS_KRUGER", "POLAR_STEREOGRAPHIC")
GEOGRAPHIC = ("4326", "4490", "CRS84", "CGCS2000", "GCS", "GEOGCS", "GEOGCRS", "DEGREE", "LONGITUDE", "LATITUDE", "EPSG:4326", "OGC:CRS84", "WGS84")


def let(x: Column, f) -> Column:
    """f of a value that is worked out once, however often f uses it: keeps long formulas small."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _meridian(zone: Column) -> Column:
    return F.radians(6.0 * (zone - 1) - 180.0 + 3.0)


def utm_to_wgs84(east: Column, north: Column, zone: Column, northern: Column) -> Column:
    """struct(lon, lat) in degrees."""
    x, y = east - FALSE_EASTING, F.when(northern, north).otherwise(north - FALSE_NORTHING)
    e2, ep2 = E2, EP2
    mu = y / SCALE / (SEMI_MAJOR * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    e1 = (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    def footpoint(m: Column) -> Column:
        terms = ((2, 3 * e1 / 2 - 27 * e1**3 / 32), (4, 21 * e1**2 / 16 - 55 * e1**4 / 32), (6, 151 * e1**3 / 96), (8, 1097 * e1**4 / 512))
        return m + sum(k * F.sin(n * m) for n, k in terms)

    def basis(foot: Column) -> Column:
        s, c, t = F.sin(foot), F.cos(foot), F.tan(foot)
        w = 1 - e2 * s * s
        n1 = SEMI_MAJOR / F.sqrt(w)
        return F.struct(foot.alias("foot"), c.alias("c"), (n1 * t / (SEMI_MAJOR * (1 - e2) / F.pow(w, F.lit(1.5)))).alias("k"), (t * t).alias("tt"), (ep2 * c * c).alias("cc"), (x / (n1 * SCALE)).alias("d"))

    def place(q: Column) -> Column:
        tt, cc = q["tt"], q["cc"]
        p = lambda k: F.pow(q["d"], F.lit(float(k)))
        lat = q["foot"] - q["k"] * (p(2) / 2 - (5 + 3 * tt + 10 * cc - 4 * cc * cc - 9 * ep2) * p(4) / 24 + (61 + 90 * tt + 298 * cc + 45 * tt * tt - 252 * ep2 - 3 * cc * cc) * p(6) / 720)
        lon = _meridian(zone) + (q["d"] - (1 + 2 * tt + cc) * p(3) / 6 + (5 - 2 * cc + 28 * tt - 3 * cc * cc + 8 * ep2 + 24 * tt * tt) * p(5) / 120) / q["c"]
        return F.struct(F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"))

    return let(let(let(mu, footpoint), basis), place)


def wgs84_to_utm(lon: Column, lat: Column, zone: Column) -> Column:
    """struct(east, north) in metres, two decimals; south of the equator with the false northing."""
    e2, ep2 = E2, EP2
    phi = F.radians(lat)
    s, c, t = F.sin(phi), F.cos(phi), F.tan(phi)
    n = SEMI_MAJOR / F.sqrt(1 - e2 * s * s)
    tt, cc, a = t * t, ep2 * c * c, (F.radians(lon) - _meridian(zone)) * c
    p = lambda k: F.pow(a, F.lit(float(k)))
    arc = SEMI_MAJOR * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - 35 * e2**3 / 3072 * F.sin(6 * phi)
    )
    east = SCALE * n * (a + (1 - tt + cc) * p(3) / 6 + (5 - 18 * tt + tt * tt + 72 * cc - 58 * ep2) * p(5) / 120) + FALSE_EASTING
    north = SCALE * (arc + n * t * (p(2) / 2 + (5 - tt + 9 * cc + 4 * cc * cc) * p(4) / 24 + (61 - 58 * tt + tt * tt + 600 * cc - 330 * ep2) * p(6) / 720))
    return F.struct(F.round(east, 2).alias("east"), F.round(F.when(lat < 0, north + FALSE_NORTHING).otherwise(north), 2).alias("north"))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180.0) / 6.0) + 1).cast("int")


def is_geographic(crs: Column) -> Column:
    """Whether a CRS text names degrees; marks of a projection win. Null is not geographic."""
    upper = F.upper(crs)
    bare = F.regexp_replace(upper, "[ _-]", "")
    any_of = lambda x, marks: F.greatest(*(F.contains(x, F.lit(m)) for m in marks))
    return F.coalesce(~any_of(upper, PROJECTED) & (any_of(bare, GEOGRAPHIC) | any_of(upper, GEOGRAPHIC)), F.lit(False))


def parse_utm_zone(crs: Column, default: int = 50) -> Column:
    """struct(zone, northern): from an EPSG code 326zz or 327zz, `UTM zone zz[NS]` or `zone zz[NS]`, else the default zone, north."""
    crs = F.coalesce(crs, F.lit(""))
    got = lambda pattern, i: F.nullif(F.regexp_extract(crs, pattern, i), F.lit(""))
    utm, plain = r"(?i)UTM\s*(?:ZONE)?\s*(\d{1,2})\s*([NS])?", r"(?i)zone\s*(\d{1,2})\s*([NS])?"
    epsg_n, epsg_s = got(r"326(\d{2})", 1), got(r"327(\d{2})", 1)
    zone = F.coalesce(epsg_n, epsg_s, got(utm, 1), got(plain, 1), F.lit(str(default))).cast("int")
    north = lambda half: F.upper(F.coalesce(half, F.lit("N"))) != "S"
    northern = F.when(epsg_n.isNotNull(), True).when(epsg_s.isNotNull(), False).when(got(utm, 1).isNotNull(), north(got(utm, 2))).when(got(plain, 1).isNotNull(), north(got(plain, 2))).otherwise(True)
    return F.struct(zone.alias("zone"), northern.alias("northern"))


def resolution_metres(step: Column, geographic: Column) -> Column:
    return F.abs(step) * F.when(geographic, METRES_A_DEGREE).otherwise(1.0)


def parse_doy(name: Column, default: Column | int = 150) -> Column:
    """Day of year in a file name: `doy_110`, else a date YYYYMMDD, else the default (also for impossible dates)."""
    default = default if isinstance(default, Column) else F.lit(default)
    said = F.nullif(F.regexp_extract(name, r"(?i)doy[_-]?(\d+)", 1), F.lit("")).cast("int")
    date = F.to_date(F.try_to_timestamp(F.regexp_extract(name, r"(\d{8})", 1), F.lit("yyyyMMdd")))
    return F.coalesce(said, F.dayofyear(date), default).cast("int")


def affine(row: Column, col: Column, a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> Column:
    """struct(x, y) of a pixel corner."""
    return F.struct((c + col * a + row * b).alias("x"), (f + col * d + row * e).alias("y"))


def pixel_of(x: Column, y: Column, a: Column, c: Column, e: Column, f: Column) -> Column:
    """struct(row, col) of the pixel that holds a point, for a transform without rotation."""
    return F.struct(F.floor((y - f) / e).cast("int").alias("row"), F.floor((x - c) / a).cast("int").alias("col"))


def from_origin(row: Column, col: Column, x0: Column, y0: Column, step: Column) -> Column:
    """struct(x, y) with y falling by rows."""
    return F.struct((x0 + col * step).alias("x"), (y0 - row * step).alias("y"))
