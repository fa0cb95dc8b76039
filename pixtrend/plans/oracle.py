"""DuckDB oracle SQL.

Only the driver's base tables exist on the oracle side, so every query carries
the stand-in derivations of ``pixtrend.sources.fixtures`` as CTEs.  Doubles are
kept exact where the engines could differ: indices and slopes come from BIGINT
sums with one final division, and integer truncation is written ``trunc``
(DuckDB's cast rounds).
"""

from __future__ import annotations

from pixtrend.constants import BANDS, SCL_BAD, TC_COEFFS_E4

_P = "cast(floor(l_extendedprice) as bigint)"
_BAD = ",".join(str(c) for c in SCL_BAD)

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("obs", f"""
select year, scene_id, cast(floor(x / 50) as int) as tile_x, cast(floor(y / 50) as int) as tile_y,
       x, y, blue, green, red, nir, swir1, swir2, scl
from (select year, scene_id, x, y, cast(case when k % 13 <> 0 then k % 12 end as int) as scl, """ + ", ".join(
    f"cast(case when (y * 200 + x) % 97 = 5 then 0 else {b} end as int) as {b}" for b in BANDS) + f"""
from (select cast(year(l_shipdate) as int) as year,
             cast(year(l_shipdate) * 100 + l_suppkey % 10 as int) as scene_id,
             cast(l_partkey % 200 as int) as x,
             cast(floor(l_partkey / 200) as int) as y,
             max(case when l_orderkey % 200 = 1 then 10000 else {_P} % 4000 end) as blue,
             max(({_P} * 3) % 4000) as green,
             max(({_P} * 7) % 4000) as red,
             max(({_P} * 11) % 11000) as nir,
             max(({_P} * 13) % 5000) as swir1,
             max(case when l_orderkey % 200 = 1 then 10000 else ({_P} * 17) % 5000 end) as swir2,
             max(l_orderkey) as k
      from lineitem group by 1, 2, 3, 4) t) t2""")

cte("scenes", """
select item_id, ts, cloud_cover, grid_code, collection, proj_epsg, west, south, east, north
from (select o_orderkey as item_id, o_orderdate as ts, case when o_orderkey % 7 = 2 then 'raw' else 'surface' end as collection,
             cast(floor(o_totalprice) as bigint) % 101 as cloud_cover,
             concat('MGRS-', cast(o_custkey % 10 as varchar)) as grid_code,
             case when o_orderkey % 3 = 0 then null else cast(32601 + o_custkey % 60 as int) end as proj_epsg,
             cast(-180 + (o_custkey * 37) % 355 as double) as west,
             cast(-79 + (o_custkey * 13) % 155 as double) as south,
             cast(-180 + (o_custkey * 37) % 355 + 4 as double) as east,
             cast(-79 + (o_custkey * 13) % 155 + 3 as double) as north
      from orders) t""")

cte("band_order", """
select * from (values (1, 'B02_10m', 'blue'), (2, 'B03_10m', 'green'), (3, 'B04_10m', 'red'),
                      (4, 'B08_10m', 'nir'), (5, 'B11_20m', 'swir1'), (6, 'B12_20m', 'swir2'),
                      (7, 'SCL_20m', 'scl')) as t(ord, asset, band)""")

cte("assets", """
select o_orderkey as item_id, b.ord, b.asset, b.band
from orders, band_order b where (o_orderkey + b.ord) % 8 <> 0""", "band_order")

cte("class_mask", """
select scene_id, x, y, cast((x * 3 + y * 5 + scene_id) % 4 as int) as cls
from obs where (x + y) % 11 <> 0 or scene_id % 3 <> 0""", "obs")

cte("done", "select o_orderkey as item_id from orders where o_orderkey % 5 = 0")

cte("bands_20m", "select scene_id, x as sx, y as sy, swir1, swir2 from obs", "obs")

cte("obs_long", " union all ".join(
    f"select scene_id, x, y, '{b}' as band, {b} as v from obs" for b in BANDS), "obs")

cte("product_paths", """
select concat('S2_', cast(item_id as varchar), '.SAFE/GRANULE/G/IMG_DATA/R', right(asset, 3),
              '/T_', asset, '.jp2') as path from assets""", "assets")

# masked stack of the flagship: nodata 0 -> NULL, SCL bad classes blanked
cte("clean", "select year, scene_id, x, y, " + ", ".join(
    f"case when not coalesce(scl, 0) in ({_BAD}) and {b} <> 0 then {b} end as {b}" for b in BANDS)
    + " from obs", "obs")


def pack(e: str) -> str:
    return f"cast(trunc(greatest(0, least(10000, coalesce({e}, 0)))) as int)"


cte("median", "select year, x, y, " + ", ".join(
    f"{pack(f'median(case when {b} > 0 then {b} end)')} as {b}" for b in BANDS)
    + " from clean group by year, x, y", "clean")


def tc_e8_sql(name: str) -> str:
    return " + ".join(f"cast(nullif({b}, 0) as bigint) * {c}"
                      for c, b in zip(TC_COEFFS_E4[name], BANDS))


cte("tc", "select year, x, y, " + ", ".join(
    f"{tc_e8_sql(n)} as {n}_e8" for n in TC_COEFFS_E4) + " from median", "median")


def slope_sql(v: str, t: str = "year", scale: int = 10, value_scale: int = 100_000_000) -> str:
    x = f"case when {v} is not null then cast({t} as bigint) end"
    n, sx, sxx, sy, sxy = (f"count({v})", f"sum({x})", f"sum({x} * {x})",
                           f"sum(cast({v} as bigint))", f"sum({x} * cast({v} as bigint))")
    return (f"case when {n} >= 2 then cast(({n} * {sxy} - {sx} * {sy}) * {scale} as double)"
            f" / cast(({n} * {sxx} - {sx} * {sx}) * {value_scale} as double) end")


cte("trend", "select x, y, " + ", ".join(
    f"{slope_sql(f'{n}_e8')} as {n}_slope, cast(count({n}_e8) as int) as n_{n}"
    for n in TC_COEFFS_E4) + " from tc group by x, y", "tc")


def stretch_sql(e: str) -> str:
    v = f"greatest(-0.3e0, least(0.3e0, {e}))"
    return f"case when {e} is not null then cast(trunc(({v} + 0.3e0) / 0.6e0 * 255) as int) else 0 end"


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as ({CTES[n][0]})" for n in order) + "\n" + body


# --------------------------------------------------------------------------- more stand-ins
# nodata-masked stack (the masked read of every scene)
cte("nd", "select year, scene_id, tile_x, tile_y, x, y, " + ", ".join(
    f"nullif({b}, 0) as {b}" for b in BANDS) + ", scl from obs", "obs")

cte("aois", """
select c_custkey as aoi_id, -179.75e0 + cast((c_custkey * 53) % 359 as double) as west,
       -69.75e0 + cast((c_custkey * 7) % 139 as double) as south,
       -179.75e0 + cast((c_custkey * 53) % 359 as double) + 0.5e0 as east,
       -69.75e0 + cast((c_custkey * 7) % 139 as double) + 0.5e0 as north
from customer""")

cte("assets_json", """
select item_id, '{' || string_agg(entry, ',' order by entry) || case when item_id % 97 <> 5 then '}' else '' end as assets
from (select item_id, '"' || asset || '":{"href":"https://h/' || k || '"' ||
             case item_id % 8
               when 0 then ',"alternate":{"s3":{"href":"s3://b/' || k || '"}}}'
               when 4 then ',"alternate":{"s3":{"href":"s3://b/' || k || '"}}}'
               when 3 then ',"alternate":{},"alternates":[{"href":"s3://e/' || k || '"}]}'
               when 7 then ',"alternate":null,"alternates":{"s3":{"href":"s3://n/' || k || '"}}}'
               when 5 then ',"alternates":[{"href":"http://m/' || k || '"},{"href":"s3://c/' || k || '"}]}'
               when 1 then ',"alternates":[{"href":"http://m/' || k || '"},{"href":"s3://c/' || k || '"}]}'
               when 2 then ',"alternate":{"S3":{"href":"s3://u/' || k || '"}}}'
               else '}' end as entry
      from (select item_id, asset, cast(item_id as varchar) || '/' || asset as k from assets) a) e
group by item_id""", "assets")

cte("class_mask_layers", """
select scene_id, x, y, l as layer, cast((cls + l) % 4 as int) as cls
from class_mask, (values (0), (1), (2)) t(l) where l = 0 or scene_id % 2 = 0""", "class_mask")

cte("grid_expected", """
select cast((max(x) - min(x) + 1) * (max(y) - min(y) + 1) as double) as expected from obs""", "obs")

cte("quality", """
select year, scene_id, count(scl) as n_present,
       count(*) filter (where scl is not null and scl <> 0) as n_valid,
       count(*) filter (where scl is not null and scl <> 0 and scl in (3, 7, 8, 9, 10, 11)) as n_bad
from obs group by year, scene_id""", "obs")

cte("quality_r", """
select q.*, g.expected, cast(n_valid as double) / g.expected as coverage,
       cast(n_bad as double) / cast(nullif(n_valid, 0) as double) as cloud_ratio
from quality q, grid_expected g""", "quality", "grid_expected")

cte("alignment", """
select scene_id, count(*) filter (where t & 1 = 1) as n_scene, count(*) filter (where t & 2 = 2) as n_mask,
       count(*) filter (where t <> 3) as n_unmatched, count(*) filter (where t <> 3) = 0 as aligned
from (select scene_id, x, y, bit_or(t) as t
      from (select scene_id, x, y, 1 as t from obs union all select scene_id, x, y, 2 as t from class_mask) u
      group by scene_id, x, y) p
group by scene_id""", "obs", "class_mask")

cte("status", """
select q.*, a.aligned,
       case when n_present = 0 then 'no_data' when n_valid = 0 then 'no_valid'
            when cloud_ratio > 0.55e0 then 'cloudy' when coverage < 0.1e0 then 'low_coverage'
            when not coalesce(a.aligned, false) then 'misaligned' else 'ok' end as status
from quality_r q left join alignment a using (scene_id)""", "quality_r", "alignment")


def nearest_q_sql(v: str, q: float) -> str:
    return (f"list_sort(list({v}) filter (where {v} is not null))"
            f"[cast(1 + round_even((count({v}) - 1) * {q!r}e0, 0) as int)]")


def moments_sql(b: str) -> str:
    v = f"cast({b} as bigint)"
    return f"count({b}) as {b}_n, sum({v}) as {b}_s1, sum({v} * {v}) as {b}_s2"


def mm(e: str) -> str:
    """Millimetres as BIGINT (both engines compute the same double)."""
    return f"cast(floor(({e}) * 1000 + 0.5e0) as bigint)"


def utm_sql(lon: str, lat: str, epsg: str) -> tuple[str, str]:
    """Krüger-series forward projection, same operation order as the Spark code."""
    from pixtrend.functions.geo import UTM_SERIES as S
    from pixtrend.constants import UTM_K0, UTM_FALSE_EASTING, UTM_FALSE_NORTHING_SOUTH
    e = repr(S["e"])
    lam = f"radians({lon} - ({epsg} % 100 * 6 - 183))"
    phi = f"radians({lat})"
    t = f"sinh(atanh(sin({phi})) - {e} * atanh({e} * sin({phi})))"
    xi_p = f"atan2({t}, cos({lam}))"
    eta_p = f"atanh(sin({lam}) / sqrt(1.0e0 + {t} * {t}))"
    xi, eta = xi_p, eta_p
    for j, a in enumerate(S["alpha"], start=1):
        xi = f"({xi} + {a!r} * sin({2 * j} * {xi_p}) * cosh({2 * j} * {eta_p}))"
        eta = f"({eta} + {a!r} * cos({2 * j} * {xi_p}) * sinh({2 * j} * {eta_p}))"
    k = repr(UTM_K0 * S["A"])
    x = f"({UTM_FALSE_EASTING!r} + {k} * {eta})"
    y = f"(case when {epsg} >= 32700 then {UTM_FALSE_NORTHING_SOUTH!r} else 0.0e0 end + {k} * {xi})"
    return x, y


def utm_epsg_sql(lon: str, lat: str) -> str:
    z = f"cast(floor(({lon} + 180) / 6) + 1 as int)"
    return f"cast(case when {lat} >= 0 then 32600 + {z} else 32700 + {z} end as int)"


def pip_sql(px: str, py: str, coords) -> str:
    """Even-odd rule with a literal polygon (edges as XOR of crossings)."""
    terms = []
    k = len(coords)
    for i in range(k):
        (ax, ay), (bx, by) = coords[i], coords[(i + 1) % k]
        if ay == by:
            continue
        terms.append(f"(({py} < {ay}) <> ({py} < {by}) and {px} < "
                     f"{float(bx - ax)!r} * ({py} - {ay}) / {float(by - ay)!r} + {ax})")
    out = "false"
    for t in terms:
        out = f"({out} <> {t})"
    return out


# --------------------------------------------------------------------------- coverage oracle
def _pt_sql(lon: str, lat: str, epsg: str) -> str:
    x, y = utm_sql(lon, lat, epsg)
    return f"{{'x': {x}, 'y': {y}}}"


def coverage_sql(min_ratio: float | None = None) -> str:
    """Independent oracle: plain bbox-intersection join, projected rings,
    Sutherland–Hodgman clip against the four AOI edges (list lambdas), shoelace
    area.  Reported as parts per million of the AOI area."""
    fp = ("[" + ", ".join(_pt_sql(a, b, "epsg") for a, b in (
        ("s_west", "s_south"), ("s_east", "s_south"), ("s_east - 1", "s_north - 1"),
        ("s_west", "s_north"))) + "]")
    aoi = ("[" + ", ".join(_pt_sql(a, b, "epsg") for a, b in (
        ("a_west", "a_south"), ("a_east", "a_south"), ("a_east", "a_north"),
        ("a_west", "a_north"))) + "]")
    empty = "[]::STRUCT(x DOUBLE, y DOUBLE)[]"
    where = "" if min_ratio is None else f"where ratio >= {min_ratio!r}e0"
    stages = []
    prev = "proj"
    for k in range(4):
        a, b = f"aoi[{k + 1}]", f"aoi[{(k + 1) % 4 + 1}]"

        def side(p, a=a, b=b):
            return f"((({b}.x - {a}.x) * ({p}.y - {a}.y) - ({b}.y - {a}.y) * ({p}.x - {a}.x)) * sgn)"
        p, q = "poly[i + 1]", "poly[(i + 1) % len(poly) + 1]"
        sp, sq = side(p), side(q)
        cut = (f"{{'x': {p}.x + {sp} / ({sp} - {sq}) * ({q}.x - {p}.x), "
               f"'y': {p}.y + {sp} / ({sp} - {sq}) * ({q}.y - {p}.y)}}")
        body = (f"CASE WHEN {sq} >= 0 AND {sp} < 0 THEN [{cut}, {q}] WHEN {sq} >= 0 THEN [{q}] "
                f"WHEN {sp} >= 0 THEN [{cut}] ELSE {empty} END")
        stages.append(f"c{k} as (select aoi_id, item_id, epsg, aoi, sgn, "
                      f"CASE WHEN len(poly) = 0 THEN poly ELSE "
                      f"flatten(list_transform(range(len(poly)), lambda i: {body})) END as poly from {prev})")
        prev = f"c{k}"

    def area(r):
        return (f"abs(coalesce(list_sum(list_transform(range(len({r})), lambda i: "
                f"{r}[i + 1].x * {r}[(i + 1) % len({r}) + 1].y - {r}[(i + 1) % len({r}) + 1].x * {r}[i + 1].y)), 0) / 2)")
    return with_ctes(f"""
, pairs as (select a.aoi_id, s.item_id, s.west as s_west, s.south as s_south, s.east as s_east,
                   s.north as s_north, a.west as a_west, a.south as a_south, a.east as a_east,
                   a.north as a_north,
                   {utm_epsg_sql("(a.west + a.east) / 2", "(a.south + a.north) / 2")} as epsg
            from scenes s join aois a
              on greatest(s.west, a.west) <= least(s.east, a.east)
             and greatest(s.south, a.south) <= least(s.north, a.north)),
proj0 as (select aoi_id, item_id, epsg, {fp} as poly, {aoi} as aoi from pairs),
proj as (select *, sign(({area('aoi').replace('abs(', '(', 1)})) as sgn from proj0),
{', '.join(stages)}
select aoi_id, item_id, epsg, cast(round(ratio * 1000000) as bigint) as coverage_ppm
from (select aoi_id, item_id, epsg, coalesce({area('poly')} / nullif({area('aoi')}, 0), 0) as ratio
      from c3) r {where}""", "scenes", "aois").replace("\n, pairs as", ",\npairs as", 1)
