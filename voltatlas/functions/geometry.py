"""Geometry as text and bytes, in Column expressions only.

Polygons are handled as ``array<array<struct<x,y>>>`` (rings), multipolygons as
an array of those.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltatlas.functions.points import in_range
from voltatlas.functions.values import as_column, double_text, let, to_double

EARTH_RADIUS_M = 6371008.8

POINT_TYPE = "struct<x:double,y:double>"
RINGS_TYPE = f"array<array<{POINT_TYPE}>>"
POLYGONS_TYPE = f"array<{RINGS_TYPE}>"

# GeoJSON type names and their WKT spelling.
WKT_NAMES = {
    "Point": "POINT",
    "MultiPoint": "MULTIPOINT",
    "LineString": "LINESTRING",
    "MultiLineString": "MULTILINESTRING",
    "Polygon": "POLYGON",
    "MultiPolygon": "MULTIPOLYGON",
}
POLYGON_TYPES = ["Polygon", "MultiPolygon"]

_NUMBER = r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?"


# ---------------------------------------------------------------- GeoJSON


def geojson_parts(geometry: Column | str) -> Column:
    """Geometry text to ``struct<type, coordinates>``, the second still text."""
    return F.from_json(as_column(geometry), "type string, coordinates string")


def geojson_wkt(geometry: Column | str) -> Column:
    """GeoJSON geometry text to WKT; coordinate digits are kept as written.

    Only the brackets change, so this is one regular expression and no number
    is parsed or printed.  A third coordinate is dropped.
    """
    names = F.create_map(*[F.lit(t) for kv in WKT_NAMES.items() for t in kv])

    def bare(parts: Column) -> Column:
        return F.struct(
            parts["type"].alias("kind"), F.try_element_at(names, parts["type"]).alias("name"),
            F.regexp_replace(parts["coordinates"], r"\s+", "").alias("numbers"),
        )

    def spell(g: Column) -> Column:
        pairs = F.regexp_replace(g["numbers"], rf"\[({_NUMBER}),({_NUMBER})(?:,[^\[\]]*)?\]", "$1 $2")
        body = F.replace(F.translate(pairs, "[]", "()"), F.lit(","), F.lit(", "))
        return (
            F.when(~g["numbers"].rlike("[0-9]"), F.concat(g["name"], F.lit(" EMPTY")))
            .when(g["kind"] == "Point", F.concat(g["name"], F.lit("("), body, F.lit(")")))
            .otherwise(F.concat(g["name"], body))
        )

    return let(let(geojson_parts(geometry), bare), spell)


def geojson_polygons(geometry: Column | str) -> Column:
    """Polygon or MultiPolygon text to an array of polygons, NULL for other types."""

    def parse(parts: Column) -> Column:
        one = F.array(F.from_json(parts["coordinates"], "array<array<array<double>>>"))
        many = F.from_json(parts["coordinates"], "array<array<array<array<double>>>>")
        return F.when(parts["type"] == "Polygon", one).when(parts["type"] == "MultiPolygon", many)

    return F.transform(
        let(geojson_parts(geometry), parse),
        lambda poly: F.transform(
            poly,
            lambda ring: F.transform(
                ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
            ),
        ),
    )


def ring_problem(polygons: Column | str) -> Column:
    """NULL for sound polygons, else what is wrong with a ring."""
    rings = F.flatten(as_column(polygons))
    short = F.exists(rings, lambda r: F.size(r) < 4)
    unclosed = F.exists(rings, lambda r: ~F.get(r, F.lit(0)).eqNullSafe(F.element_at(r, -1)))
    return (
        F.when(rings.isNull() | (F.size(rings) == 0), "no rings")
        .when(short, "ring under 4 points")
        .when(unclosed, "ring not closed")
    )


# -------------------------------------------------------------------- WKT


def coordinate_text(value: Column) -> Column:
    return F.regexp_replace(double_text(value), r"\.0$", "")


def polygons_wkt(polygons: Column | str, digits: int | None = None) -> Column:
    """Array of polygons to POLYGON (one) or MULTIPOLYGON text."""

    def number(v: Column) -> Column:
        return coordinate_text(v if digits is None else F.round(v, digits))

    def ring_text(ring: Column) -> Column:
        points = F.transform(ring, lambda p: F.concat(number(p["x"]), F.lit(" "), number(p["y"])))
        return F.concat(F.lit("("), F.array_join(points, ", "), F.lit(")"))

    polys = as_column(polygons)
    bodies = F.transform(
        polys,
        lambda rings: F.concat(F.lit("("), F.array_join(F.transform(rings, ring_text), ", "), F.lit(")")),
    )
    joined = F.array_join(bodies, ", ")
    return (
        F.when(F.size(F.flatten(polys)) == 0, F.lit("POLYGON EMPTY"))
        .when(F.size(polys) == 1, F.concat(F.lit("POLYGON"), joined))
        .when(F.size(polys) > 1, F.concat(F.lit("MULTIPOLYGON("), joined, F.lit(")")))
    )


def linestring_wkt(coordinates: Column | str) -> Column:
    """Array of ``{latitude, longitude}`` to LINESTRING text.

    Points that are missing, not numeric or out of range are skipped; fewer
    than two left give NULL.
    """
    numbers = F.transform(
        as_column(coordinates),
        lambda c: F.struct(to_double(c["longitude"]).alias("lon"), to_double(c["latitude"]).alias("lat")),
    )
    good = F.filter(numbers, lambda p: in_range(p["lon"], p["lat"]))
    texts = F.transform(good, lambda p: F.concat(double_text(p["lon"]), F.lit(" "), double_text(p["lat"])))
    whole = lambda t: F.concat(F.lit("LINESTRING("), F.array_join(t, ", "), F.lit(")"))
    return let(texts, lambda t: F.when(F.size(t) >= 2, whole(t)))


def first_vertex(wkt: Column | str) -> Column:
    """First coordinate pair of any WKT as ``struct<lon, lat>``."""
    pattern = rf"\(\s*({_NUMBER})\s+({_NUMBER})"
    s = as_column(wkt)
    return F.struct(
        to_double(F.regexp_extract(s, pattern, 1)).alias("lon"),
        to_double(F.regexp_extract(s, pattern, 2)).alias("lat"),
    )


# -------------------------------------------------------------------- WKB
#
# Written as SQL text: one parse instead of a call into the JVM per node.


def _sql_let(value: str, name: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _sql_hex(offset: str, n_bytes: int) -> str:
    """Hex digits of the number at ``offset`` of s.data, highest byte first."""
    swap = "".join(f"${i}" for i in range(n_bytes, 0, -1))
    raw = f"hex(substring(s.data, int({offset}) + 1, {n_bytes}))"
    return f"if(s.little, regexp_replace({raw}, '{'(..)' * n_bytes}', '{swap}'), {raw})"


def _sql_u32(offset: str) -> str:
    return f"bigint(conv({_sql_hex(offset, 4)}, 16, 10))"


def _sql_f64(offset: str) -> str:
    split = _sql_let(
        _sql_hex(offset, 8), "h",
        "named_struct('top', int(conv(substr(h, 1, 3), 16, 10)), 'frac', double(conv(substr(h, 4), 16, 10)))",
    )
    value = (
        "if(v.top % 2048 = 0 and v.frac = 0, 0D, if(v.top >= 2048, -1D, 1D) "
        f"* (1D + v.frac / {2.0**52:.1f}D) * power(2D, v.top % 2048 - 1023))"
    )
    return _sql_let(split, "v", value)


def _sql_steps(n: str) -> str:
    return f"if({n} > 0, sequence(1L, {n}), cast(array() as array<bigint>))"


def _sql_header(offset: str) -> str:
    """Bytes of the order and type fields, plus a spatial reference id if flagged."""
    return f"if(({_sql_u32(f'{offset} + 1')} & {0x20000000}) <> 0, 9, 5)"


def _sql_polygon(start: str) -> str:
    """``struct<pos, rings>`` of the polygon whose header is at ``start``."""
    point = f"named_struct('x', {_sql_f64('a.pos + 4 + 16 * (i - 1)')}, 'y', {_sql_f64('a.pos + 12 + 16 * (i - 1)')})"
    ring = f"transform({_sql_steps('a.n')}, i -> {point})"
    counted = f"named_struct('pos', acc.pos, 'rings', acc.rings, 'n', {_sql_u32('acc.pos')})"
    added = f"named_struct('pos', int(a.pos + 4 + 16 * a.n), 'rings', concat(a.rings, array({ring})))"
    init = f"named_struct('pos', int(body + 4), 'rings', cast(array() as {RINGS_TYPE}))"
    rings = f"aggregate({_sql_steps(_sql_u32('body'))}, {init}, (acc, k) -> {_sql_let(counted, 'a', added)})"
    return _sql_let(f"int({start} + {_sql_header(start)})", "body", rings)


def wkb_polygons(wkb: str) -> Column:
    """WKB or EWKB Polygon/MultiPolygon, either byte order, to an array of polygons.

    ``wkb`` is a column name or SQL text.
    """
    one = f"array({_sql_polygon('0')}.rings)"
    step = _sql_let(
        f"named_struct('polys', m.polys, 'p', {_sql_polygon('m.pos')})", "b",
        "named_struct('pos', b.p.pos, 'polys', concat(b.polys, array(b.p.rings)))",
    )
    init = f"named_struct('pos', int(first + 4), 'polys', cast(array() as {POLYGONS_TYPE}))"
    many = _sql_let(
        f"int({_sql_header('0')})", "first",
        f"aggregate({_sql_steps(_sql_u32('first'))}, {init}, (m, j) -> {step}, m -> m.polys)",
    )
    by_kind = _sql_let(
        f"{_sql_u32('1')} & 255", "kind", f"case kind when 3 then {one} when 6 then {many} end"
    )
    source = f"named_struct('data', {wkb}, 'little', hex(substring({wkb}, 1, 1)) = '01')"
    return F.expr(_sql_let(source, "s", by_kind))


def _sql_double_hex(value: str) -> str:
    """The 16 hex digits of a double's bits."""
    guess = f"named_struct('x', {value}, 'g', int(floor(log2(abs({value})))))"
    exact = (
        "named_struct('x', g.x, 'e', case when power(2D, g.g) > abs(g.x) then g.g - 1 "
        "when power(2D, g.g + 1) <= abs(g.x) then g.g + 1 else g.g end)"
    )
    bits = (
        f"(shiftleft(bigint(e.e + 1023), 52) | bigint((abs(e.x) / power(2D, e.e) - 1) * {2.0**52:.1f}D) "
        "| if(e.x < 0, shiftleft(1L, 63), 0L))"
    )
    return _sql_let(
        _sql_let(guess, "g", exact), "e", f"if(e.x = 0, repeat('0', 16), lpad(hex({bits}), 16, '0'))"
    )


def _sql_u32_hex(n: str) -> str:
    return f"lpad(hex(bigint({n})), 8, '0')"


def polygons_wkb(polygons: str) -> Column:
    """Array of polygons to big-endian WKB, Polygon for one and MultiPolygon for more."""
    point = f"concat({_sql_double_hex('p.x')}, {_sql_double_hex('p.y')})"
    ring = f"concat({_sql_u32_hex('size(r)')}, array_join(transform(r, p -> {point}), ''))"
    polygon = f"concat('0000000003', {_sql_u32_hex('size(q)')}, array_join(transform(q, r -> {ring}), ''))"
    bodies = f"array_join(transform(s, q -> {polygon}), '')"
    whole = f"case size(s) when 0 then null when 1 then {bodies} else concat('0000000006', {_sql_u32_hex('size(s)')}, {bodies}) end"
    return F.expr(f"unhex({_sql_let(polygons, 's', whole)})")


def _sql_join(items: str) -> str:
    """The texts of an array one after the other; NULL if one of them is."""
    return _sql_let(items, "parts", "if(exists(parts, h -> h is null), null, array_join(parts, ''))")


def geojson_wkb(geometry: str, promote: bool = False) -> Column:
    """GeoJSON text of any of the six types to big-endian WKB of that type.

    ``promote`` makes a Polygon a MultiPolygon of one.  NULL for other types, for
    a missing coordinate and for an empty point; a third coordinate is dropped.
    """
    point = f"concat({_sql_double_hex('get(p, 0)')}, {_sql_double_hex('get(p, 1)')})"
    line = lambda s: f"concat({_sql_u32_hex(f'size({s})')}, {_sql_join(f'transform({s}, p -> {point})')})"
    rings = lambda s: f"concat({_sql_u32_hex(f'size({s})')}, {_sql_join(f'transform({s}, r -> {line("r")})')})"
    many = lambda code, one: f"concat('000000000{code}', {_sql_u32_hex('size(s)')}, {_sql_join(f'transform(s, {one})')})"
    polygons = many(6, f"q -> concat('0000000003', {rings('q')})")
    # WKB code, nesting of the coordinates, and the text; fixed values of the format.
    forms = {
        "Point": ("array<array<double>>", "concat('[', g.coordinates, ']')", f"concat('0000000001', {_sql_join(f'transform(s, p -> {point})')})"),
        "LineString": ("array<array<double>>", "g.coordinates", f"concat('0000000002', {line('s')})"),
        "MultiPoint": ("array<array<double>>", "g.coordinates", many(4, f"p -> concat('0000000001', {point})")),
        "MultiLineString": ("array<array<array<double>>>", "g.coordinates", many(5, f"r -> concat('0000000002', {line('r')})")),
        "MultiPolygon": ("array<array<array<array<double>>>>", "g.coordinates", polygons),
        "Polygon": ("array<array<array<double>>>", "g.coordinates", f"concat('0000000003', {rings('s')})"),
    }
    if promote:
        forms["Polygon"] = ("array<array<array<array<double>>>>", "concat('[', g.coordinates, ']')", polygons)
    cases = " ".join(f"when '{t}' then {_sql_let(f"from_json({source}, '{shape}')", 's', text)}" for t, (shape, source, text) in forms.items())
    parts = f"from_json({geometry}, 'type string, coordinates string')"
    return F.expr(f"unhex({_sql_let(parts, 'g', f'case g.type {cases} end')})")


def readable(result: Column, source: Column | str) -> Column:
    """``result``; an error where there was a geometry and none came of it."""
    source = as_column(source)
    shown = F.concat(F.lit("cannot convert geometry: "), F.left(source, F.lit(200)))
    return F.when(source.isNotNull() & result.isNull(), F.raise_error(shown)).otherwise(result)


# ----------------------------------------------------------- reprojection

# The parameters of ETRS89-extended / LAEA Europe (EPSG:3035) on GRS80.
_A = 6378137.0
_F = 1 / 298.257222101
_LAT0, _LON0 = math.radians(52.0), math.radians(10.0)
_FALSE_E, _FALSE_N = 4321000.0, 3210000.0

_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_QP = _q(math.pi / 2)
_BETA0 = math.asin(_q(_LAT0) / _QP)
_RQ = _A * math.sqrt(_QP / 2)
_D = _A * math.cos(_LAT0) / (math.sqrt(1 - _E2 * math.sin(_LAT0) ** 2) * _RQ * math.cos(_BETA0))

LAEA_EUROPE = {
    "false_e": _FALSE_E,
    "false_n": _FALSE_N,
    "lat0": _LAT0,
    "lon0": _LON0,
    "beta0": _BETA0,
    "rq": _RQ,
    "d": _D,
    "c2": _E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040,
    "c4": 23 * _E2**2 / 360 + 251 * _E2**3 / 3780,
    "c6": 761 * _E2**3 / 45360,
}


def _sql_laea(points: str) -> str:
    """Closed-form inverse; every step is its own pass, so no term is worked out twice."""
    k = LAEA_EUROPE
    d, sin_b, cos_b = k["d"], math.sin(k["beta0"]), math.cos(k["beta0"])
    shifted = f"transform({points}, p -> named_struct('x', p.x - {k['false_e']!r}D, 'y', p.y - {k['false_n']!r}D))"
    polar = f"transform({shifted}, p -> named_struct('x', p.x, 'y', p.y, 'rho', hypot(p.x / {d!r}D, p.y * {d!r}D)))"
    angle = (
        f"transform({polar}, p -> named_struct('x', p.x, 'y', p.y, 'rho', p.rho, "
        f"'c', 2 * asin(p.rho / {2 * k['rq']!r}D)))"
    )
    sphere = (
        f"transform({angle}, p -> named_struct("
        f"'beta', if(p.rho = 0, {k['beta0']!r}D, "
        f"asin(cos(p.c) * {sin_b!r}D + sin(p.c) * p.y * {d * cos_b!r}D / p.rho)), "
        f"'dlon', atan2(p.x * sin(p.c), p.rho * cos(p.c) * {d * cos_b!r}D - p.y * sin(p.c) * {d * d * sin_b!r}D)))"
    )
    return (
        f"transform({sphere}, p -> named_struct('x', degrees(p.dlon + {k['lon0']!r}D), "
        f"'y', degrees(p.beta + {k['c2']!r}D * sin(2 * p.beta) + {k['c4']!r}D * sin(4 * p.beta) "
        f"+ {k['c6']!r}D * sin(6 * p.beta))))"
    )


def laea_to_lonlat(easting: str, northing: str) -> Column:
    """One EPSG:3035 position to ``struct<lon, lat>``; arguments are names or SQL text."""
    point = f"array(named_struct('x', double({easting}), 'y', double({northing})))"
    return F.expr(_sql_let(f"{_sql_laea(point)}[0]", "q", "named_struct('lon', q.x, 'lat', q.y)"))


def laea_polygons_to_lonlat(polygons: str) -> Column:
    """Polygons in EPSG:3035 metres to degrees, x = lon and y = lat."""
    return F.expr(f"transform({polygons}, rings -> transform(rings, ring -> {_sql_laea('ring')}))")


# --------------------------------------------------------------- distance


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    a1, o1, a2, o2 = (F.radians(as_column(v)) for v in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)
