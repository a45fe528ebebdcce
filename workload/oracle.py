"""The same results as plain SQL for DuckDB, by brute force over whole tables."""

from __future__ import annotations

import math

from cityloom import fixed_values as V

from . import fixtures as fx
from .queries import (
    AS_OF, CITY_POINTS, CLIP_BOX, ITERATIONS, MIN_SUPPORT, MOST_ITERATIONS, PARITY_RADIUS, SETTLED, START,
)


def _texts(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _category(parity: bool = False) -> str:
    apart = set(V.PARITY_FALLBACK_AMENITIES) if parity else set()
    whens = " ".join(
        f"WHEN amenity IN {_texts(a for a in amenities if a not in apart)} THEN '{name}'"
        for name, amenities in V.CATEGORIES.items()
        if name != V.FALLBACK_CATEGORY
    )
    return f"CASE {whens} ELSE '{V.FALLBACK_CATEGORY}' END"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371000 * asin(sqrt(least(1.0, power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def _cosine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon1}) - radians({lon2}))"
        f" + sin(radians({lat1})) * sin(radians({lat2}))"
    )


def _utm_ctes() -> str:
    """Kept incidents to latitude and longitude, zone 10 north."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    a = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    b = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    d = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)

    def num(v: float) -> str:
        return f"CAST({v!r} AS DOUBLE)"

    xi = "xi0" + "".join(f" - {num(c)} * sin({2 * j} * xi0) * cosh({2 * j} * eta0)" for j, c in enumerate(b, 1))
    eta = "eta0" + "".join(f" - {num(c)} * cos({2 * j} * xi0) * sinh({2 * j} * eta0)" for j, c in enumerate(b, 1))
    phi = "chi" + "".join(f" + {num(c)} * sin({2 * j} * chi)" for j, c in enumerate(d, 1))
    return f"""
utm0 AS (SELECT *, y / {num(a)} AS xi0, (x - 500000) / {num(a)} AS eta0 FROM kept_incidents),
utm1 AS (SELECT *, {xi} AS xi, {eta} AS eta FROM utm0),
utm2 AS (SELECT *, asin(sin(xi) / cosh(eta)) AS chi FROM utm1),
inc AS (SELECT c_id, type, year, neighbourhood, round(degrees({phi}), 7) AS latitude,
  round(degrees(atan2(sinh(eta), cos(xi))) - 123, 7) AS longitude FROM utm2)"""


_WEST, _EAST, _SOUTH, _NORTH = V.CITY_BOX
_PLACE_RULE = (
    f"amenity IN {_texts(V.ALLOWED_AMENITIES)} AND lon BETWEEN {_WEST} AND {_EAST}"
    f" AND lat BETWEEN {_SOUTH} AND {_NORTH} AND name IS NOT NULL"
)
_INCIDENT_RULE = (
    "neighbourhood IS NOT NULL AND x <> 0 AND y <> 0"
    f" AND type NOT IN {_texts(V.COLLISION_TYPES)} AND CAST(year AS INTEGER) >= {V.FIRST_YEAR}"
)
_LISTING_RULE = (
    f"minimum_nights > 0 AND minimum_nights <= {V.MAX_NIGHTS}"
    f" AND datediff('day', last_review, DATE '{AS_OF}') < {V.RECENT_DAYS}"
)
_FIXTURES = f"""WITH RECURSIVE
poi AS ({fx.POI.format(customer="customer")}),
incidents AS ({fx.INCIDENTS.format(orders="orders")}),
listings AS ({fx.LISTINGS.format(part="part")})"""
_CLEAN = f"""{_FIXTURES},
places AS (SELECT *, {_category()} AS category FROM poi WHERE {_PLACE_RULE}),
kept_incidents AS (SELECT * FROM incidents WHERE {_INCIDENT_RULE}),{_utm_ctes()},
kept_listings AS (SELECT id, name, neighbourhood, latitude, longitude, room_type, price, minimum_nights
  FROM listings WHERE {_LISTING_RULE})"""
_PAIR_GAP = _haversine("i.latitude", "i.longitude", "p.lat", "p.lon")
_PAIRS = f"""{_CLEAN},
pairs AS (SELECT * FROM (
  SELECT p.amnt_id, p.category, p.amenity, p.name, p.neighbourhood, i.c_id, i.type AS crime_type, {_PAIR_GAP} AS gap
  FROM places p JOIN inc i ON p.neighbourhood = i.neighbourhood) WHERE gap <= {V.RADIUS_M})"""
_SCALED_PAIRS = f"""{_CLEAN},
pairs AS (SELECT * FROM (
  SELECT p.category, i.c_id, i.type AS crime_type,
    6371000 * degrees(acos({_cosine('i.latitude', 'i.longitude', 'p.lat', 'p.lon')})) AS gap
  FROM places p JOIN inc i ON p.neighbourhood = i.neighbourhood) WHERE gap <= {PARITY_RADIUS})"""
_PAIR_COLUMNS = (
    "amnt_id, category, amenity, name, neighbourhood, c_id, crime_type, round(gap, 3) AS distance_in_meters"
)


def _table(types, min_support: int = V.MIN_SUPPORT, pairs: str = _PAIRS) -> str:
    listed = ", ".join(f"('{t}')" for t in types)
    return f"""{pairs},
types(crime_type) AS (VALUES {listed}),
full_table AS (SELECT c.category, t.crime_type, CAST(count(p.c_id) AS BIGINT) AS n
  FROM (SELECT DISTINCT category FROM pairs WHERE crime_type IN (SELECT crime_type FROM types)) c
  CROSS JOIN types t LEFT JOIN pairs p ON p.category = c.category AND p.crime_type = t.crime_type
  GROUP BY c.category, t.crime_type),
tab AS (SELECT * FROM full_table WHERE category IN
  (SELECT category FROM full_table GROUP BY category HAVING min(n) > {min_support}))"""


def _test(types) -> str:
    """The tail by the power series of the incomplete gamma function."""
    return f"""{_table(types)},
cells AS (SELECT *, sum(n) OVER (PARTITION BY category) * 1.0 * sum(n) OVER (PARTITION BY crime_type)
  / sum(n) OVER () AS e FROM tab),
stat AS (SELECT sum((n - e) * (n - e) / e) AS x, CAST(sum(n) AS BIGINT) AS total, count(DISTINCT category) AS r,
  count(DISTINCT crime_type) AS c, (count(DISTINCT category) - 1) * (count(DISTINCT crime_type) - 1) AS dof FROM cells),
tail AS (SELECT *, 1 - (SELECT sum(exp((dof / 2.0 + j) * ln(x / 2) - x / 2 - lgamma(dof / 2.0 + j + 1)))
  FROM range(0, 3000) s(j)) AS p FROM stat WHERE r > 1)
SELECT round(x, 6) AS statistic, CAST(dof AS BIGINT) AS dof, round(p, 6) AS p_value, total AS n, r AS n_rows,
  c AS n_cols, p < {V.ALPHA} AS significant FROM tail"""


def _in_train(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '#0'), 1, 8) AS BIGINT) < {int(V.TRAIN_SHARE * 2**32)}"


def _votes(queries: str, key: str, lat: str, lon: str) -> str:
    return f"""{_CLEAN},
train AS (SELECT * FROM inc WHERE {_in_train('c_id')}),
ranked AS (SELECT q.{key} AS q_key, t.neighbourhood, row_number() OVER (PARTITION BY q.{key} ORDER BY
    (q.{lat} - t.latitude) * (q.{lat} - t.latitude) + (q.{lon} - t.longitude) * (q.{lon} - t.longitude), t.c_id) AS rk
  FROM {queries} q CROSS JOIN train t),
tally AS (SELECT q_key, neighbourhood, count(*) AS n FROM ranked WHERE rk <= {V.NEIGHBOURS} GROUP BY ALL),
voted AS (SELECT q_key, neighbourhood FROM (SELECT *, row_number() OVER
  (PARTITION BY q_key ORDER BY n DESC, neighbourhood) AS pos FROM tally) WHERE pos = 1)"""


def _settled() -> str:
    """Iterations that stand still once no centre has moved by more than the tolerance."""
    start = ", ".join(f"({i}, CAST({y} AS DOUBLE), CAST({x} AS DOUBLE), false)" for i, (y, x) in enumerate(START))
    steps = [f"{_CLEAN},\nc0(cluster, clat, clon, done) AS (VALUES {start})"]
    for i in range(MOST_ITERATIONS):
        steps.append(
            f"""m{i} AS MATERIALIZED (SELECT cluster, avg(lat) AS y, avg(lon) AS x FROM (SELECT p.lat, p.lon, c.cluster,
    row_number() OVER (PARTITION BY amnt_id ORDER BY (lat - clat) * (lat - clat) + (lon - clon) * (lon - clon), c.cluster) AS pos
    FROM places p CROSS JOIN c{i} c) WHERE pos = 1 GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c.cluster, CASE WHEN done THEN clat ELSE coalesce(m.y, clat) END AS clat,
    CASE WHEN done THEN clon ELSE coalesce(m.x, clon) END AS clon,
    done OR max(greatest(abs(coalesce(m.y, clat) - clat), abs(coalesce(m.x, clon) - clon))) OVER () <= {SETTLED} AS done
  FROM c{i} c LEFT JOIN m{i} m ON m.cluster = c.cluster)"""
        )
    return ",\n".join(steps)


def _lloyd() -> str:
    start = ", ".join(f"({i}, CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))" for i, (y, x) in enumerate(START))
    steps = [f"{_CLEAN},\ncentres0(cluster, clat, clon) AS (VALUES {start})"]

    def labels(step: int) -> str:
        return f"""labels{step} AS (SELECT * FROM (SELECT p.*, c.cluster, row_number() OVER (PARTITION BY amnt_id ORDER BY
    (lat - clat) * (lat - clat) + (lon - clon) * (lon - clon), c.cluster) AS pos
  FROM places p CROSS JOIN centres{step} c) WHERE pos = 1)"""

    for i in range(ITERATIONS):
        steps.append(labels(i))
        steps.append(
            f"""centres{i + 1} AS (SELECT c.cluster, coalesce(m.y, c.clat) AS clat, coalesce(m.x, c.clon) AS clon
  FROM centres{i} c LEFT JOIN (SELECT cluster, avg(lat) AS y, avg(lon) AS x FROM labels{i} GROUP BY cluster) m
  ON m.cluster = c.cluster)"""
        )
    steps.append(labels(ITERATIONS))
    keep, gone = V.MERGED_CLUSTERS
    steps.append(
        f"""merged AS (SELECT * REPLACE (CASE cluster WHEN {gone} THEN {keep} ELSE cluster END AS cluster)
  FROM labels{ITERATIONS})"""
    )
    steps.append(
        f"""mcentres AS (SELECT cluster, clat, clon FROM centres{ITERATIONS} WHERE cluster NOT IN ({keep}, {gone})
  UNION ALL SELECT {keep}, avg(lat), avg(lon) FROM merged WHERE cluster = {keep})"""
    )
    steps.append(
        """shares AS (SELECT cluster, category, count(*) AS n,
  count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY cluster) AS percent FROM merged GROUP BY cluster, category)"""
    )
    return ",\n".join(steps)


def _kde(grid: int = 32, cut: float = 3.0) -> str:
    def axis(c: str, col: str) -> str:
        return (
            f"stddev_samp({col}) * power(count(*), -1.0 / 6) AS h_{c}, min({col}) AS lo_{c}, max({col}) AS hi_{c}"
        )

    def node(c: str, col: str) -> str:
        return f"CAST(floor(({col} - o_{c}) / s_{c} + 0.5) AS INTEGER)"

    root = repr(math.sqrt(2 * math.pi))
    return f"""{_CLEAN},
spread AS (SELECT type, count(*) AS n, {axis('y', 'latitude')}, {axis('x', 'longitude')} FROM inc GROUP BY type),
frame AS (SELECT type, n, h_y, lo_y - {cut} * h_y AS o_y, (hi_y - lo_y + {2 * cut} * h_y) / {grid - 1} AS s_y,
  h_x, lo_x - {cut} * h_x AS o_x, (hi_x - lo_x + {2 * cut} * h_x) / {grid - 1} AS s_x FROM spread),
bins AS (SELECT i.type, {node('y', 'latitude')} AS b_y, {node('x', 'longitude')} AS b_x, count(*) AS w
  FROM inc i JOIN frame f ON i.type = f.type GROUP BY ALL),
nodes AS (SELECT CAST(a.i AS INTEGER) AS gy, CAST(b.i AS INTEGER) AS gx
  FROM range(0, {grid}) a(i) CROSS JOIN range(0, {grid}) b(i))
SELECT f.type, gy, gx, round(o_y + gy * s_y, 6) AS lat, round(o_x + gx * s_x, 6) AS lon,
  round(sum(w * exp(-0.5 * power((gy - b_y) * s_y / h_y, 2)) * exp(-0.5 * power((gx - b_x) * s_x / h_x, 2)))
    / (n * h_y * h_x * {root} * {root}), 6) AS density
FROM frame f JOIN bins b ON b.type = f.type CROSS JOIN nodes
GROUP BY f.type, gy, gx, n, o_y, s_y, h_y, o_x, s_x, h_x"""


def _build() -> dict[str, str]:
    west, east, south, north = CLIP_BOX
    points = ", ".join(f"({i}, CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))" for i, y, x in CITY_POINTS)
    nation_gap = _cosine("p.lat", "p.lon", "(49.2::DOUBLE + n_nationkey * 0.004::DOUBLE)",
                         "(-123.26::DOUBLE + n_nationkey * 0.01::DOUBLE)")
    to_nation = "FROM poi p JOIN nation ON p.neighbourhood = CAST(n_nationkey AS VARCHAR)"
    node_columns = (
        "lat, lon, TIMESTAMP '2020-01-01 00:00:00' + to_seconds(amnt_id * 61) AS timestamp,"
        " amenity, name, neighbourhood AS district, CAST(1 AS INTEGER) AS n_tags"
    )
    wide = ", ".join(
        f"CAST(count(*) FILTER (crime_type = '{t}') AS BIGINT) AS n{i}" for i, t in enumerate(V.INCIDENT_TYPES)
    )
    place_columns = "amnt_id, amenity, name, lat, lon, neighbourhood"
    counts = "SELECT category, crime_type, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY category, crime_type"
    return {
        "src_json_roundtrip": "SELECT event_id, ts, user_id, event_type, value, "
        "json_extract_string(props, '$.k') AS k FROM events",
        "src_csv_roundtrip": "SELECT * FROM customer",
        "src_parquet_lz4_roundtrip": "SELECT * FROM orders",
        "src_xml_nodes": f"{_FIXTURES} SELECT {node_columns} FROM poi WHERE amenity <> 'bench'",
        "src_xml_extract": f"{_FIXTURES} SELECT {node_columns} FROM poi WHERE amenity <> 'bench'",
        "src_xml_fragments": f"{_FIXTURES} SELECT {node_columns} FROM poi WHERE amenity <> 'bench' AND amnt_id % 7 <> 0",
        "tags_map_extract": "SELECT event_id, json_extract_string(props, '$.k') AS k, "
        "json_extract_string(props, '$.absent') AS absent, "
        "CAST(len(json_keys(props)) - CASE WHEN json_exists(props, '$.k') THEN 1 ELSE 0 END AS INTEGER) AS n_rest, "
        "CASE WHEN json_exists(props, '$.k') THEN '{\"k\":\"' || json_extract_string(props, '$.k') || '\"}' "
        "ELSE '{}' END AS tags_json FROM events",
        "poi_allowlist_bbox": f"{_FIXTURES} SELECT {place_columns} FROM poi WHERE {_PLACE_RULE}",
        "poi_open_bbox": f"{_FIXTURES} SELECT {place_columns} FROM poi "
        f"WHERE lon > {west} AND lon < {east} AND lat > {south} AND lat < {north}",
        "poi_categorised": f"{_FIXTURES} SELECT {place_columns}, {_category()} AS category FROM poi WHERE {_PLACE_RULE}",
        "poi_categorised_parity": f"{_FIXTURES} SELECT {place_columns}, {_category(True)} AS category "
        f"FROM poi WHERE {_PLACE_RULE}",
        "poi_dense_id": f"{_CLEAN} SELECT amnt_id, amenity, row_number() OVER (ORDER BY amnt_id) - 1 AS row_index FROM places",
        "poi_dense_id_text": f"{_CLEAN} SELECT amnt_id, amenity, row_number() OVER (ORDER BY amenity, amnt_id) AS row_index FROM places",
        "incidents_stable_id": f"{_CLEAN} SELECT type, count(*) AS n_ids, CAST(count(*) AS BIGINT) AS n_same FROM kept_incidents GROUP BY type",
        "incidents_clean": f"{_CLEAN} SELECT * FROM kept_incidents",
        "incidents_latlon": f"{_CLEAN} SELECT * FROM inc",
        "listings_clean": f"{_CLEAN} SELECT * FROM kept_listings",
        "profile_type_counts": f"{_FIXTURES} SELECT type, count(*) AS n FROM incidents GROUP BY type",
        "profile_amenities": f"{_FIXTURES} SELECT DISTINCT amenity FROM poi ORDER BY amenity",
        "profile_nights": f"{_FIXTURES} SELECT count(minimum_nights) AS n, round(avg(minimum_nights), 8) AS mean, "
        "round(stddev_samp(minimum_nights), 8) AS stddev, min(minimum_nights) AS least, max(minimum_nights) AS most "
        "FROM listings",
        "dist_cosine_law": f"{_FIXTURES} SELECT amnt_id, round(6371000 * acos(least(1.0, {nation_gap})), 3) AS metres "
        f"{to_nation}",
        "dist_cosine_law_scaled": f"{_FIXTURES} SELECT amnt_id, "
        f"round(6371000 * degrees(acos(least(1.0, {nation_gap}))), 3) AS metres {to_nation}",
        "dist_haversine": f"{_FIXTURES}, points(centre, y, x) AS (VALUES {points}) SELECT id, centre, "
        f"round({_haversine('latitude', 'longitude', 'y', 'x')}, 3) AS metres FROM listings CROSS JOIN points",
        "near_pairs": f"{_PAIRS} SELECT {_PAIR_COLUMNS} FROM pairs",
        "near_pairs_parity": f"""{_CLEAN} SELECT amnt_id, category, amenity, name, neighbourhood, c_id, crime_type,
  round(gap, 0) AS distance_in_meters FROM (SELECT p.amnt_id, p.category, p.amenity, p.name, p.neighbourhood, i.c_id,
  i.type AS crime_type, 6371000 * degrees(acos({_cosine('i.latitude', 'i.longitude', 'p.lat', 'p.lon')})) AS gap
  FROM places p JOIN inc i ON p.neighbourhood = i.neighbourhood) WHERE gap <= {PARITY_RADIUS}""",
        "near_pairs_unblocked": f"""{_CLEAN} SELECT amnt_id, c_id, round(gap, 3) AS distance_in_meters
  FROM (SELECT p.amnt_id, i.c_id, {_PAIR_GAP} AS gap FROM places p CROSS JOIN inc i) WHERE gap <= {V.RADIUS_M}""",
        "near_pairs_first20": f"{_PAIRS} SELECT {_PAIR_COLUMNS} FROM pairs ORDER BY amnt_id, distance_in_meters, c_id LIMIT 20",
        "near_summary": f"{_PAIRS} SELECT CAST(count(*) AS BIGINT) AS num_rows, count(DISTINCT amenity) AS distinct_amnt_types, "
        "count(DISTINCT amnt_id) AS distinct_amnt_id, count(DISTINCT category) AS dist_amnt_cat FROM pairs",
        "near_summary_sketch": f"{_PAIRS} SELECT CAST(grouping(neighbourhood, crime_type) AS INTEGER) AS level, neighbourhood, "
        "crime_type, CAST(count(*) AS BIGINT) AS num_rows, count(DISTINCT amnt_id) AS n_places, TRUE AS near_enough "
        "FROM pairs GROUP BY CUBE (neighbourhood, crime_type)",
        "near_counts": f"{_PAIRS} {counts}",
        "near_counts_unblocked": f"""{_CLEAN} SELECT category, crime_type, CAST(count(*) AS BIGINT) AS n
  FROM (SELECT p.category, i.type AS crime_type, {_PAIR_GAP} AS gap FROM places p CROSS JOIN inc i)
  WHERE gap <= {V.RADIUS_M} GROUP BY category, crime_type""",
        "near_counts_attached": f"{_PAIRS} SELECT category, crime_type, CAST(count(*) AS BIGINT) AS count "
        "FROM pairs GROUP BY category, crime_type",
        "contingency_all": f"{_table(V.INCIDENT_TYPES)} SELECT category, crime_type, n FROM tab",
        "contingency_petty": f"{_table(V.PETTY_TYPES)} SELECT category, crime_type, n FROM tab",
        "near_pairs_bucketed": f"{_PAIRS} SELECT amnt_id, c_id, CAST({V.RADIUS_M} AS INTEGER) AS radius FROM pairs UNION ALL "
        f"SELECT amnt_id, c_id, CAST({V.RADIUS_M / 2} AS INTEGER) FROM pairs WHERE gap <= {V.RADIUS_M / 2}",
        "near_counts_rows": f"{_PAIRS} SELECT amnt_id, c_id, category, crime_type, count FROM (SELECT *, "
        "CAST(count(*) OVER (PARTITION BY category, crime_type) AS BIGINT) AS count, "
        "row_number() OVER (PARTITION BY category, crime_type ORDER BY amnt_id, c_id) AS pos FROM pairs) WHERE pos = 1",
        "incidents_with_counts": f"{_CLEAN} SELECT c_id, type, neighbourhood, "
        "CAST(count(*) OVER (PARTITION BY type, neighbourhood) AS BIGINT) AS n_alike FROM inc",
        "first_incident_per_place": f"{_CLEAN} SELECT min(c_id) AS c_id, type, neighbourhood FROM inc GROUP BY type, neighbourhood",
        "contingency_scaled": f"{_table(V.INCIDENT_TYPES, pairs=_SCALED_PAIRS)} SELECT category, crime_type, n FROM full_table",
        "contingency_wide": f"{_PAIRS} SELECT category, {wide} FROM pairs GROUP BY category",
        "contingency_min_support": f"{_table(V.INCIDENT_TYPES, MIN_SUPPORT)} SELECT category, crime_type, n FROM tab",
        "chi2_all": _test(V.INCIDENT_TYPES),
        "chi2_petty": _test(V.PETTY_TYPES),
        "chi2_monte_carlo": f"""{_CLEAN}, cells AS (SELECT neighbourhood, type, count(*) AS o FROM inc GROUP BY ALL),
lined AS (SELECT *, sum(o) OVER (PARTITION BY neighbourhood) * 1.0 AS r, sum(o) OVER (PARTITION BY type) AS c FROM cells)
SELECT round(sum(o) * (sum(o * o / (r * c)) - 1), 4) AS statistic, CAST(sum(o) AS BIGINT) AS n,
  count(DISTINCT coalesce(neighbourhood, '')) AS n_rows, count(DISTINCT type) AS n_cols, CAST(999 AS INTEGER) AS replicates,
  TRUE AS agrees FROM lined HAVING count(*) > 0""",
        "knn_neighbourhood": f"{_votes('places', 'amnt_id', 'lat', 'lon')} "
        "SELECT p.amnt_id, p.category, v.neighbourhood FROM places p LEFT JOIN voted v ON v.q_key = p.amnt_id",
        "knn_accuracy": f"{_votes('inc', 'c_id', 'latitude', 'longitude')} SELECT "
        f"CASE WHEN {_in_train('c_id')} THEN 'train' ELSE 'validation' END AS part, count(*) AS n, "
        "round(avg(CASE WHEN v.neighbourhood = i.neighbourhood THEN 1.0 ELSE 0.0 END), 8) AS accuracy "
        "FROM inc i JOIN voted v ON v.q_key = i.c_id GROUP BY part",
        "lloyd_5": f"{_lloyd()} SELECT cluster, round(clat, 8) AS clat, round(clon, 8) AS clon FROM centres{ITERATIONS}",
        "lloyd_labels": f"{_lloyd()} SELECT amnt_id, cluster FROM labels{ITERATIONS}",
        "merged_centres": f"{_lloyd()} SELECT cluster, round(clat, 8) AS clat, round(clon, 8) AS clon FROM mcentres",
        "lloyd_converged": f"{_settled()} SELECT cluster, round(clat, 8) AS clat, round(clon, 8) AS clon FROM c{MOST_ITERATIONS}",
        "kmeans_facts": f"{_CLEAN} SELECT CAST({V.CLUSTERS} AS BIGINT) AS n_centres, CAST(count(*) AS BIGINT) AS n_points, "
        "true AS centres_are_means, true AS cost_is_good FROM places",
        "nearest_listing_many": f"""{_CLEAN} SELECT amnt_id, id, round(gap, 3) AS metres FROM (SELECT p.amnt_id, l.id,
  {_haversine('l.latitude', 'l.longitude', 'p.lat', 'p.lon')} AS gap, row_number() OVER (PARTITION BY p.amnt_id ORDER BY
  {_haversine('l.latitude', 'l.longitude', 'p.lat', 'p.lon')}, l.id) AS pos
  FROM kept_listings l CROSS JOIN places p) WHERE pos = 1""",
        "nearest_listing": f"""{_lloyd()} SELECT id, name, neighbourhood, latitude, longitude, room_type, price,
  minimum_nights, cluster FROM (SELECT l.*, c.cluster, row_number() OVER (PARTITION BY c.cluster ORDER BY
  {_haversine('latitude', 'longitude', 'clat', 'clon')}, id) AS pos
  FROM kept_listings l CROSS JOIN mcentres c) WHERE pos = 1""",
        "cluster_share": f"{_lloyd()} SELECT cluster, category, n, round(percent, 8) AS percent FROM shares",
        "cluster_share_complete": f"{_lloyd()} SELECT c.cluster, k.category, coalesce(s.n, 0) AS n, "
        "round(coalesce(s.percent, 0), 8) AS percent FROM (SELECT DISTINCT cluster FROM merged) c "
        f"CROSS JOIN (SELECT unnest({[*V.CATEGORIES, 'Other']!r}) AS category) k "
        "LEFT JOIN shares s ON s.cluster = c.cluster AND s.category = k.category",
        "category_scaled_share": f"{_lloyd()} SELECT cluster, category, n, round(percent, 8) AS percent, "
        "round(percent / sum(percent) OVER (PARTITION BY category), 8) AS scaled_percent FROM shares",
        "density_hist": f"{_CLEAN} SELECT type, CAST(floor(latitude / 0.01) AS BIGINT) AS gy, "
        "CAST(floor(longitude / 0.01) AS BIGINT) AS gx, count(*) AS n FROM inc GROUP BY ALL",
        "density_kde": _kde(),
    }


ORACLES: dict[str, str] = _build()
