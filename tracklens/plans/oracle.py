"""Oracle SQL: the same pipeline written as plain SQL for DuckDB, used to
check every registered query on the fixture (tables are DuckDB views).

Exponent literals (``5e-1``) keep arithmetic in DOUBLE; DuckDB's
double-to-integer cast rounds, so buckets use ``floor`` explicitly.
"""

from __future__ import annotations

from tracklens.config import EARTH_RADIUS_NM, EncounterConfig
from tracklens.sources.fixture import fixture_sql_duckdb

CFG = EncounterConfig()
BASE = "event_id, mmsi, ts_unix, lat, lon, sog, cog, name, ship_type, mobile_type"


def d(x: float) -> str:
    """A DOUBLE literal."""
    s = repr(float(x))
    return s if "e" in s else s + "e0"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)"
    )
    return f"(2 * {d(EARTH_RADIUS_NM)} * asin(sqrt(least(1e0, greatest(0e0, {a})))))"


def circ(x: str, y: str) -> str:
    return f"least(abs(({x}) - ({y})), 3.6e2 - abs(({x}) - ({y})))"


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


c = CFG
W = c.weights
_CTES: list[tuple[str, str]] = [
    ("pings", fixture_sql_duckdb()),
    (
        "valid",
        "SELECT * FROM pings WHERE ts_unix IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND mmsi IS NOT NULL "
        "AND lat BETWEEN -9e1 AND 9e1 AND lon BETWEEN -1.8e2 AND 1.8e2 AND NOT (lat = 0e0 AND lon = 0e0)",
    ),
    ("timew", f"SELECT * FROM valid WHERE ts_unix BETWEEN {c.start_unix} AND {c.end_unix}"),
    (
        "bbox",
        f"SELECT * FROM timew WHERE lat BETWEEN {d(c.center_lat - c.lat_margin_deg)} AND {d(c.center_lat + c.lat_margin_deg)} "
        f"AND lon BETWEEN {d(c.center_lon - c.lon_margin_deg)} AND {d(c.center_lon + c.lon_margin_deg)}",
    ),
    (
        "radius",
        f"SELECT *, {hav(d(c.center_lat), d(c.center_lon), 'lat', 'lon')} AS dist_center_nm FROM bbox "
        f"WHERE {hav(d(c.center_lat), d(c.center_lon), 'lat', 'lon')} <= {d(c.radius_nm)}",
    ),
    ("classa", f"SELECT {BASE} FROM radius WHERE mobile_type = '{c.mobile_class}'"),
    ("notsar", f"SELECT * FROM classa WHERE NOT starts_with(CAST(mmsi AS VARCHAR), '{c.excluded_mmsi_prefix}')"),
    (
        "lagged",
        "SELECT *, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(ts_unix) OVER w AS prev_unix "
        "FROM notsar WINDOW w AS (PARTITION BY mmsi ORDER BY ts_unix, event_id)",
    ),
    (
        "withdist",
        f"SELECT *, CASE WHEN prev_lat IS NOT NULL THEN {hav('prev_lat', 'prev_lon', 'lat', 'lon')} END AS dist_prev FROM lagged",
    ),
    (
        "dedup",
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, ts_unix "
        "ORDER BY dist_prev ASC NULLS LAST, event_id) AS rn FROM withdist) WHERE rn = 1",
    ),
    (
        "speed",
        "SELECT *, CASE WHEN prev_unix IS NOT NULL AND (ts_unix - prev_unix) / 3.6e3 > 0 AND dist_prev IS NOT NULL "
        "THEN dist_prev / ((ts_unix - prev_unix) / 3.6e3) END AS implied_speed FROM dedup",
    ),
    ("cleaned", f"SELECT * FROM speed WHERE implied_speed IS NULL OR implied_speed <= {d(c.max_implied_speed_kn)}"),
    ("medians", "SELECT mmsi, quantile_disc(sog, 0.5) AS median_sog FROM cleaned GROUP BY mmsi"),
    (
        "clean",
        f"SELECT {BASE} FROM cleaned WHERE mmsi IN (SELECT mmsi FROM medians WHERE median_sog >= {d(c.min_median_sog_kn)})",
    ),
    (
        "mp",
        f"SELECT {BASE}, CAST(floor(lat / {d(c.grid_cell_deg)}) AS INTEGER) AS grid_lat, "
        f"CAST(floor(lon / {d(c.grid_cell_deg)}) AS INTEGER) AS grid_lon, "
        f"CAST(floor(ts_unix / {d(c.time_bucket_s)}) AS BIGINT) AS time_bucket, "
        "lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(ts_unix) OVER w AS prev_unix "
        f"FROM clean WHERE sog > {d(c.moving_sog_kn)} WINDOW w AS (PARTITION BY mmsi ORDER BY ts_unix, event_id)",
    ),
    (
        "pairs",
        "SELECT a.mmsi AS mmsi_a, b.mmsi AS mmsi_b, a.name AS name_a, b.name AS name_b, "
        "a.ts_unix AS ts_unix_a, b.ts_unix AS ts_unix_b, a.lat AS lat_a, a.lon AS lon_a, b.lat AS lat_b, b.lon AS lon_b, "
        "a.sog AS sog_a, b.sog AS sog_b, a.grid_lat AS grid_lat_a, a.grid_lon AS grid_lon_a, "
        "b.grid_lat AS grid_lat_b, b.grid_lon AS grid_lon_b, a.time_bucket AS time_bucket, "
        f"{hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS distance_nm, "
        "CASE WHEN a.prev_unix IS NOT NULL AND (a.ts_unix - a.prev_unix) / 3.6e3 > 0 THEN "
        f"({hav('a.prev_lat', 'a.prev_lon', 'b.prev_lat', 'b.prev_lon')} - {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')}) "
        "/ ((a.ts_unix - a.prev_unix) / 3.6e3) END AS closing_speed_kn "
        "FROM mp a JOIN mp b ON a.time_bucket = b.time_bucket "
        "AND b.grid_lat BETWEEN a.grid_lat - 1 AND a.grid_lat + 1 AND b.grid_lon BETWEEN a.grid_lon - 1 AND a.grid_lon + 1 "
        f"AND a.mmsi < b.mmsi WHERE {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} < {d(c.close_distance_nm)}",
    ),
    (
        "conv",
        f"SELECT * FROM pairs WHERE closing_speed_kn IS NOT NULL AND closing_speed_kn > {d(c.min_closing_speed_kn)}",
    ),
    (
        "top3",
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mmsi_a, mmsi_b "
        "ORDER BY round(distance_nm, 9), round(closing_speed_kn, 6) DESC, ts_unix_a, ts_unix_b) AS rn FROM conv) "
        f"WHERE rn <= {c.candidates_per_pair}",
    ),
    (
        "density",
        "SELECT grid_lat, grid_lon, time_bucket, count(DISTINCT mmsi) AS vessels_in_cell FROM mp "
        "GROUP BY grid_lat, grid_lon, time_bucket",
    ),
    (
        "cands",
        "SELECT t.*, da.vessels_in_cell AS vessels_in_cell_a, db.vessels_in_cell AS vessels_in_cell_b FROM top3 t "
        "LEFT JOIN density da ON da.grid_lat = t.grid_lat_a AND da.grid_lon = t.grid_lon_a AND da.time_bucket = t.time_bucket "
        "LEFT JOIN density db ON db.grid_lat = t.grid_lat_b AND db.grid_lon = t.grid_lon_b AND db.time_bucket = t.time_bucket",
    ),
    ("ds_end", "SELECT max(ts_unix) AS dataset_end_unix FROM clean"),
    ("lastp", "SELECT mmsi, max(ts_unix) AS last_ping_unix FROM clean GROUP BY mmsi"),
    (
        "genuine",
        f"SELECT l.mmsi, l.last_ping_unix FROM lastp l, ds_end e WHERE l.last_ping_unix < e.dataset_end_unix - {c.end_buffer_s}",
    ),
    (
        "sil0",
        "SELECT t.*, ga.last_ping_unix AS last_ping_a, gb.last_ping_unix AS last_ping_b, t.ts_unix_a AS event_unix, "
        "ga.last_ping_unix - t.ts_unix_a AS silence_a, gb.last_ping_unix - t.ts_unix_a AS silence_b "
        "FROM cands t LEFT JOIN genuine ga ON ga.mmsi = t.mmsi_a LEFT JOIN genuine gb ON gb.mmsi = t.mmsi_b",
    ),
    (
        "sil1",
        f"SELECT *, (silence_a IS NOT NULL AND silence_a >= 0 AND silence_a < {c.silence_window_s}) AS silent_a, "
        f"(silence_b IS NOT NULL AND silence_b >= 0 AND silence_b < {c.silence_window_s}) AS silent_b FROM sil0",
    ),
    (
        "sil",
        "SELECT *, CAST(silent_a AS INTEGER) + CAST(silent_b AS INTEGER) AS silence_count, "
        "least(CASE WHEN silent_a THEN silence_a ELSE 999999 END, CASE WHEN silent_b THEN silence_b ELSE 999999 END) "
        "AS min_silence_s FROM sil1",
    ),
    (
        "evts",
        "SELECT DISTINCT mmsi, event_unix FROM (SELECT mmsi_a AS mmsi, ts_unix_a AS event_unix FROM cands "
        "UNION ALL SELECT mmsi_b AS mmsi, ts_unix_b AS event_unix FROM cands)",
    ),
    (
        "ewp",
        "SELECT e.mmsi, e.event_unix, p.ts_unix, p.ts_unix - e.event_unix AS offset_s, p.sog, p.cog "
        f"FROM evts e JOIN clean p ON p.mmsi = e.mmsi AND p.ts_unix BETWEEN e.event_unix - {c.reaction_window_s} "
        f"AND e.event_unix + {c.reaction_window_s}",
    ),
    (
        "kin",
        "SELECT mmsi, event_unix, avg(CASE WHEN offset_s < 0 THEN sog END) AS sog_before, "
        "avg(CASE WHEN offset_s > 0 THEN sog END) AS sog_after, avg(CASE WHEN offset_s < 0 THEN cog END) AS cog_before, "
        "avg(CASE WHEN offset_s > 0 THEN cog END) AS cog_after FROM ewp GROUP BY mmsi, event_unix",
    ),
    (
        "rx0",
        "SELECT s.*, ka.sog_before AS sb_a, ka.sog_after AS sa_a, ka.cog_before AS cb_a, ka.cog_after AS ca_a, "
        "kb.sog_before AS sb_b, kb.sog_after AS sa_b, kb.cog_before AS cb_b, kb.cog_after AS ca_b FROM sil s "
        "LEFT JOIN kin ka ON ka.mmsi = s.mmsi_a AND ka.event_unix = s.ts_unix_a "
        "LEFT JOIN kin kb ON kb.mmsi = s.mmsi_b AND kb.event_unix = s.ts_unix_b",
    ),
    (
        "rx",
        "SELECT * EXCLUDE (sb_a, sa_a, cb_a, ca_a, sb_b, sa_b, cb_b, ca_b), "
        "greatest(coalesce(sb_a, 0e0) - coalesce(sa_a, 0e0), coalesce(sb_b, 0e0) - coalesce(sa_b, 0e0), 0e0) AS max_sog_drop, "
        f"greatest(CASE WHEN cb_a IS NOT NULL AND ca_a IS NOT NULL THEN {circ('cb_a', 'ca_a')} ELSE 0e0 END, "
        f"CASE WHEN cb_b IS NOT NULL AND ca_b IS NOT NULL THEN {circ('cb_b', 'ca_b')} ELSE 0e0 END, 0e0) AS max_cog_change, "
        f"CASE WHEN ca_a IS NOT NULL AND ca_b IS NOT NULL THEN {circ('ca_a', 'ca_b')} ELSE 0e0 END AS post_event_divergence "
        "FROM rx0",
    ),
    (
        "dens",
        "SELECT *, (coalesce(vessels_in_cell_a, 1) + coalesce(vessels_in_cell_b, 1)) / 2e0 AS scene_density FROM rx",
    ),
    (
        "capped",
        "SELECT * REPLACE (least(max_cog_change, "
        f"{d(W.cap_cog_change)}) AS max_cog_change, least(post_event_divergence, {d(W.cap_divergence)}) AS post_event_divergence, "
        f"least(max_sog_drop, {d(W.cap_sog_drop)}) AS max_sog_drop, least(closing_speed_kn, {d(W.cap_closing_speed)}) AS closing_speed_kn) "
        "FROM dens",
    ),
    (
        "scored",
        "SELECT *, "
        f"CASE WHEN silence_count >= 1 THEN {d(W.silence_one)} ELSE 0e0 END "
        f"+ CASE WHEN silence_count >= 2 THEN {d(W.silence_two_extra)} ELSE 0e0 END "
        f"+ CASE WHEN min_silence_s < 999999 THEN ({d(c.silence_window_s)} - least(min_silence_s, {d(c.silence_window_s)})) "
        f"/ {d(c.silence_window_s)} * {d(W.quick_silence_max)} ELSE 0e0 END "
        f"+ (max_sog_drop * {d(W.sog_drop)} + max_cog_change * {d(W.cog_change)} + post_event_divergence * {d(W.divergence)} "
        f"+ closing_speed_kn * {d(W.closing_speed)}) "
        f"- CASE WHEN max_sog_drop < {d(W.no_reaction_below_kn)} THEN (1e0 - max_sog_drop) * {d(W.no_reaction)} ELSE 0e0 END "
        f"- CASE WHEN distance_nm * 1.852e3 > {d(W.distance_free_m)} THEN (distance_nm * 1.852e3 - {d(W.distance_free_m)}) "
        f"/ 1e2 * {d(W.distance_per_100m)} ELSE 0e0 END "
        f"- greatest((scene_density - {d(W.density_free)}) * {d(W.density_per_vessel)}, 0e0) AS collision_score FROM capped",
    ),
    (
        "best",
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY mmsi_a, mmsi_b ORDER BY "
        "round(collision_score, 6) DESC, round(distance_nm, 9), ts_unix_a, ts_unix_b) AS rn FROM scored) WHERE rn = 1",
    ),
    (
        "top5",
        "SELECT *, row_number() OVER (ORDER BY round(collision_score, 6) DESC, round(distance_nm, 9), mmsi_a, mmsi_b, "
        "ts_unix_a, ts_unix_b) AS rank FROM (SELECT * FROM best ORDER BY round(collision_score, 6) DESC, "
        f"round(distance_nm, 9), mmsi_a, mmsi_b, ts_unix_a, ts_unix_b LIMIT {c.top_k_pairs})",
    ),
    ("win", "SELECT * FROM top5 WHERE rank = 1"),
    (
        "wevent",
        "SELECT t.mmsi_a, t.mmsi_b, w.name_a, w.name_b, t.ts_unix_a AS event_unix, (t.lat_a + t.lat_b) / 2 AS event_lat, "
        "(t.lon_a + t.lon_b) / 2 AS event_lon, t.distance_nm, t.distance_nm * 1.852e3 AS distance_m, w.collision_score "
        "FROM cands t JOIN win w ON t.mmsi_a = w.mmsi_a AND t.mmsi_b = w.mmsi_b "
        "ORDER BY round(t.distance_nm, 9), t.ts_unix_a, t.ts_unix_b LIMIT 1",
    ),
    (
        "vw",
        "SELECT rank, 'a' AS side, mmsi_a AS mmsi, coalesce(nullif(name_a, ''), 'MMSI ' || CAST(mmsi_a AS VARCHAR)) "
        "AS vessel_label, ts_unix_a AS event_unix, ts_unix_a AS fetch_unix FROM top5 "
        "UNION ALL SELECT rank, 'b' AS side, mmsi_b AS mmsi, coalesce(nullif(name_b, ''), 'MMSI ' || CAST(mmsi_b AS VARCHAR)) "
        "AS vessel_label, ts_unix_a AS event_unix, ts_unix_b AS fetch_unix FROM top5",
    ),
    (
        "fetched",
        f"SELECT * FROM clean p WHERE EXISTS (SELECT 1 FROM vw f WHERE f.mmsi = p.mmsi AND p.ts_unix BETWEEN "
        f"f.fetch_unix - {c.trajectory_window_s} AND f.fetch_unix + {c.trajectory_window_s})",
    ),
    (
        "traj",
        "SELECT v.rank, v.side, p.mmsi, v.vessel_label, v.event_unix, p.ts_unix, p.lat, p.lon, p.sog, p.cog, "
        "CASE WHEN p.ts_unix <= v.event_unix THEN 'before' ELSE 'after' END AS phase FROM vw v JOIN fetched p "
        f"ON p.mmsi = v.mmsi AND p.ts_unix BETWEEN v.event_unix - {c.trajectory_window_s} AND v.event_unix + {c.trajectory_window_s}",
    ),
]
_INDEX = {name: i for i, (name, _) in enumerate(_CTES)}


def with_ctes(last: str, select: str) -> str:
    """``WITH`` all CTEs up to and including ``last``, then ``select``."""
    upto = _CTES[: _INDEX[last] + 1]
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in upto) + "\n" + select


SCORED_OUT = (
    "mmsi_a, mmsi_b, name_a, name_b, ts_unix_a, ts_unix_b, lat_a, lon_a, lat_b, lon_b, sog_a, sog_b, "
    "round(distance_nm, 6) AS distance_nm, round(closing_speed_kn, 6) AS closing_speed_kn, vessels_in_cell_a, "
    "vessels_in_cell_b, last_ping_a, last_ping_b, event_unix, silence_a, silence_b, silent_a, silent_b, silence_count, "
    "min_silence_s, round(max_sog_drop, 6) AS max_sog_drop, round(max_cog_change, 6) AS max_cog_change, "
    "round(post_event_divergence, 6) AS post_event_divergence, scene_density, round(collision_score, 6) AS collision_score"
)
CAND_OUT = (
    "mmsi_a, mmsi_b, name_a, name_b, ts_unix_a, ts_unix_b, lat_a, lon_a, lat_b, lon_b, sog_a, sog_b, "
    "round(distance_nm, 6) AS distance_nm, round(closing_speed_kn, 6) AS closing_speed_kn, vessels_in_cell_a, vessels_in_cell_b"
)
STAGES = [
    ("raw", "pings"), ("valid", "valid"), ("time_window", "timew"), ("bbox", "bbox"), ("radius", "radius"),
    ("class_a", "classa"), ("not_sar", "notsar"), ("dedup", "dedup"), ("implied_speed", "cleaned"),
    ("moving_vessels", "clean"), ("moving_pings", None), ("close_pairs", "pairs"), ("converging", "conv"),
    ("top3", "top3"),
]


def _stage_counts() -> str:
    parts = []
    for stage, cte in STAGES:
        if cte is None:
            parts.append(f"SELECT '{stage}' AS stage, count(*) AS n_rows, count(DISTINCT mmsi) AS n_vessels FROM mp")
        elif cte in ("pairs", "conv", "top3"):
            parts.append(
                f"SELECT '{stage}' AS stage, count(*) AS n_rows, count(DISTINCT (mmsi_a, mmsi_b)) AS n_vessels FROM {cte}"
            )
        else:
            parts.append(f"SELECT '{stage}' AS stage, count(*) AS n_rows, count(DISTINCT mmsi) AS n_vessels FROM {cte}")
    return with_ctes("top3", "\nUNION ALL ".join(parts))


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["valid_pings"] = with_ctes("valid", f"SELECT {BASE} FROM valid")
    q["time_window"] = with_ctes("timew", f"SELECT {BASE} FROM timew")
    q["geo_bbox"] = with_ctes("bbox", f"SELECT {BASE} FROM bbox")
    q["geo_radius"] = with_ctes("radius", f"SELECT {BASE}, round(dist_center_nm, 6) AS dist_center_nm FROM radius")
    q["class_a"] = with_ctes("classa", f"SELECT {BASE} FROM classa")
    q["not_sar"] = with_ctes("notsar", f"SELECT {BASE} FROM notsar")
    q["previous_fix"] = with_ctes(
        "withdist", f"SELECT {BASE}, prev_lat, prev_lon, prev_unix, round(dist_prev, 6) AS dist_prev FROM withdist"
    )
    q["dedup_pings"] = with_ctes("dedup", f"SELECT {BASE}, prev_unix, round(dist_prev, 6) AS dist_prev FROM dedup")
    q["implied_speed"] = with_ctes("cleaned", f"SELECT {BASE}, round(implied_speed, 6) AS implied_speed FROM cleaned")
    plain = BASE.replace("event_id, ", "")
    q["ais_parse"] = with_ctes(
        "pings",
        f"SELECT {plain} FROM (SELECT * REPLACE (CASE WHEN event_id % 89 = 4 THEN NULL ELSE sog END AS sog) FROM pings "
        "WHERE event_id % 89 NOT IN (1, 2, 3)) WHERE ts_unix IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND mmsi IS NOT NULL "
        "AND lat BETWEEN -9e1 AND 9e1 AND lon BETWEEN -1.8e2 AND 1.8e2 AND NOT (lat = 0e0 AND lon = 0e0)",
    )
    text = (
        "SELECT *, event_id % 83 = 8 OR event_id % 71 = 9 AS malformed, "
        "event_id % 89 <> 1 AS time_ok, CASE WHEN event_id % 89 = 2 THEN NULL ELSE mmsi END AS m, "
        "CASE WHEN event_id % 89 = 3 THEN NULL ELSE lat END AS la, CASE WHEN event_id % 83 = 8 THEN NULL ELSE lon END AS lo FROM pings"
    )
    judged = (
        "SELECT *, CASE WHEN time_ok AND m IS NOT NULL AND la IS NOT NULL AND lo IS NOT NULL AND la BETWEEN -9e1 AND 9e1 "
        "AND lo BETWEEN -1.8e2 AND 1.8e2 AND NOT (la = 0e0 AND lo = 0e0) THEN NULL WHEN malformed THEN 'malformed line' WHEN NOT time_ok THEN 'bad time' "
        f"WHEN m IS NULL OR la IS NULL OR lo IS NULL THEN 'bad number' WHEN la = 0e0 AND lo = 0e0 THEN 'position (0, 0)' ELSE 'out of range' END AS reason FROM ({text})"
    )
    q["ais_csv"] = with_ctes("pings", f"SELECT {plain.replace('sog', 'CASE WHEN event_id % 89 = 4 THEN NULL ELSE sog END AS sog')} FROM ({judged}) WHERE reason IS NULL")
    q["ais_csv_rejects"] = with_ctes(
        "pings",
        f"SELECT reason, malformed, CASE WHEN event_id % 89 = 2 THEN 'n/a' ELSE CAST(mmsi AS VARCHAR) END AS mmsi FROM ({judged}) WHERE reason IS NOT NULL",
    )
    content = "ts_unix, lat, lon, sog NULLS FIRST, cog NULLS FIRST, name NULLS FIRST, ship_type NULLS FIRST, mobile_type NULLS FIRST"
    step = hav("prev_lat", "prev_lon", "lat", "lon")
    q["clean_tracks_content_order"] = with_ctes(
        "notsar",
        f"SELECT {plain} FROM (SELECT *, CASE WHEN ts_unix > prev_unix THEN dist_prev / ((ts_unix - prev_unix) / 3.6e3) END AS implied FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY mmsi, ts_unix ORDER BY dist_prev NULLS LAST, {content}) AS rn FROM ("
        f"SELECT *, CASE WHEN prev_lat IS NOT NULL THEN {step} END AS dist_prev FROM ("
        "SELECT *, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(ts_unix) OVER w AS prev_unix FROM ("
        f"SELECT {plain} FROM notsar UNION ALL SELECT {plain} FROM notsar WHERE event_id % 13 = 0) "
        f"WINDOW w AS (PARTITION BY mmsi ORDER BY {content})))) WHERE rn = 1) WHERE implied IS NULL OR implied <= {d(c.max_implied_speed_kn)}",
    )
    q["clean_tracks"] = with_ctes("cleaned", f"SELECT {BASE} FROM cleaned")
    q["median_speed"] = with_ctes("medians", "SELECT mmsi, median_sog FROM medians")
    q["moving_vessels"] = with_ctes("clean", f"SELECT {BASE} FROM clean")
    q["moving_pings"] = with_ctes(
        "mp", f"SELECT {BASE}, grid_lat, grid_lon, time_bucket, prev_lat, prev_lon, prev_unix FROM mp"
    )
    q["neighbor_cells"] = with_ctes(
        "mp",
        "SELECT event_id, mmsi, time_bucket, grid_lat, grid_lon, grid_lat + dy AS join_grid_lat, grid_lon + dx AS join_grid_lon "
        "FROM mp, (SELECT * FROM range(-1, 2) r1(dy), range(-1, 2) r2(dx))",
    )
    pair_cols = "mmsi_a, mmsi_b, ts_unix_a, ts_unix_b, lat_a, lon_a, lat_b, lon_b, round(distance_nm, 6) AS distance_nm"
    q["close_pairs"] = with_ctes("pairs", f"SELECT {pair_cols} FROM pairs")
    q["proximity_pairs"] = with_ctes("pairs", f"SELECT {pair_cols} FROM pairs")
    q["closing_speed"] = with_ctes(
        "pairs", f"SELECT {pair_cols}, round(closing_speed_kn, 6) AS closing_speed_kn FROM pairs"
    )
    q["converging_pairs"] = with_ctes(
        "conv", f"SELECT {pair_cols}, round(closing_speed_kn, 6) AS closing_speed_kn FROM conv"
    )
    q["top3_per_pair"] = with_ctes(
        "top3", f"SELECT {pair_cols}, round(closing_speed_kn, 6) AS closing_speed_kn FROM top3"
    )
    q["cell_density"] = with_ctes("density", "SELECT grid_lat, grid_lon, time_bucket, vessels_in_cell FROM density")
    q["pair_density"] = with_ctes(
        "cands", "SELECT mmsi_a, mmsi_b, ts_unix_a, ts_unix_b, vessels_in_cell_a, vessels_in_cell_b FROM cands"
    )
    q["candidates"] = with_ctes("cands", f"SELECT {CAND_OUT} FROM cands")
    q["last_ping"] = with_ctes("genuine", "SELECT mmsi, last_ping_unix FROM genuine")
    q["silence_flags"] = with_ctes(
        "sil",
        "SELECT mmsi_a, mmsi_b, ts_unix_a, ts_unix_b, last_ping_a, last_ping_b, event_unix, silence_a, silence_b, "
        "silent_a, silent_b, silence_count, min_silence_s FROM sil",
    )
    q["adaptive_pairs"] = q["close_pairs"]
    q["daily_clean_tracks"] = q["clean_tracks"]
    q["daily_median_speed"] = q["median_speed"]
    q["daily_last_ping"] = q["last_ping"]
    q["daily_silence_flags"] = q["silence_flags"]
    q["event_keys"] = with_ctes("evts", "SELECT mmsi, event_unix FROM evts")
    q["event_window_pings"] = with_ctes(
        "ewp", "SELECT mmsi, event_unix, ts_unix, offset_s, sog, cog FROM ewp"
    )
    q["pre_post_kinematics"] = with_ctes(
        "kin",
        "SELECT mmsi, event_unix, round(sog_before, 6) AS sog_before, round(sog_after, 6) AS sog_after, "
        "round(cog_before, 6) AS cog_before, round(cog_after, 6) AS cog_after FROM kin",
    )
    q["event_reaction"] = with_ctes(
        "rx",
        "SELECT mmsi_a, mmsi_b, ts_unix_a, ts_unix_b, round(max_sog_drop, 6) AS max_sog_drop, "
        "round(max_cog_change, 6) AS max_cog_change, round(post_event_divergence, 6) AS post_event_divergence FROM rx",
    )
    q["scene_density"] = with_ctes("dens", "SELECT mmsi_a, mmsi_b, ts_unix_a, ts_unix_b, scene_density FROM dens")
    q["score"] = with_ctes("scored", f"SELECT {SCORED_OUT} FROM scored")
    q["score_without_tracks"] = with_ctes(
        "cands",
        f"SELECT {CAND_OUT.replace('round(closing_speed_kn, 6) AS closing_speed_kn', 'round(least(closing_speed_kn, '
        + d(W.cap_closing_speed) + '), 6) AS closing_speed_kn')}, false AS ais_silence, 0 AS silence_count, "
        "999999 AS min_silence_s, 0e0 AS max_sog_drop, 0e0 AS max_cog_change, 0e0 AS post_event_divergence, "
        "(coalesce(vessels_in_cell_a, 1) + coalesce(vessels_in_cell_b, 1)) / 2e0 AS scene_density, "
        f"round(0e0 + 0e0 + 0e0 + (0e0 * {d(W.sog_drop)} + 0e0 * {d(W.cog_change)} + 0e0 * {d(W.divergence)} "
        f"+ least(closing_speed_kn, {d(W.cap_closing_speed)}) * {d(W.closing_speed)}) "
        f"- (1e0 - 0e0) * {d(W.no_reaction)} "
        f"- CASE WHEN distance_nm * 1.852e3 > {d(W.distance_free_m)} THEN (distance_nm * 1.852e3 - {d(W.distance_free_m)}) "
        f"/ 1e2 * {d(W.distance_per_100m)} ELSE 0e0 END "
        f"- greatest(((coalesce(vessels_in_cell_a, 1) + coalesce(vessels_in_cell_b, 1)) / 2e0 - {d(W.density_free)}) "
        f"* {d(W.density_per_vessel)}, 0e0), 6) AS collision_score FROM cands",
    )
    q["best_per_pair"] = with_ctes("best", f"SELECT {SCORED_OUT} FROM best")
    q["top5_pairs"] = with_ctes("top5", f"SELECT rank, {SCORED_OUT} FROM top5")
    q["winner"] = with_ctes("win", f"SELECT {SCORED_OUT} FROM win")
    q["winner_event"] = with_ctes(
        "wevent",
        "SELECT mmsi_a, mmsi_b, name_a, name_b, event_unix, event_lat, event_lon, round(distance_nm, 6) AS distance_nm, "
        "round(distance_m, 6) AS distance_m, round(collision_score, 6) AS collision_score FROM wevent",
    )
    q["trajectory_one"] = with_ctes(
        "wevent",
        "SELECT p.mmsi, p.ts_unix, p.lat, p.lon, p.sog, p.cog FROM clean p JOIN wevent e ON p.mmsi = e.mmsi_a "
        f"AND p.ts_unix BETWEEN e.event_unix - {c.trajectory_window_s} AND e.event_unix + {c.trajectory_window_s}",
    )
    q["trajectories"] = with_ctes(
        "traj", "SELECT rank, side, mmsi, vessel_label, event_unix, ts_unix, lat, lon, sog, cog, phase FROM traj"
    )
    q["chord_pairs"] = q["close_pairs"]
    q["daily_trajectories"] = q["trajectories"]
    pt = "CAST(round(lon * 1e6) AS BIGINT) || ' ' || CAST(round(lat * 1e6) AS BIGINT)"
    q["trajectory_lines"] = with_ctes(
        "traj",
        "SELECT rank, side, mmsi, vessel_label, event_unix, count(*) FILTER (WHERE phase = 'before') AS n_before, "
        "count(*) FILTER (WHERE phase = 'after') AS n_after, "
        f"CASE WHEN count(*) FILTER (WHERE phase = 'before') >= 2 THEN string_agg({pt}, ',' ORDER BY ts_unix) "
        "FILTER (WHERE phase = 'before') END AS line_before, "
        f"CASE WHEN count(*) FILTER (WHERE phase = 'after') >= 2 THEN string_agg({pt}, ',' ORDER BY ts_unix) "
        "FILTER (WHERE phase = 'after') END AS line_after, "
        "arg_min(lat, ts_unix) FILTER (WHERE phase = 'before') AS start_lat, "
        "arg_min(lon, ts_unix) FILTER (WHERE phase = 'before') AS start_lon, "
        "arg_max(lat, ts_unix) AS end_lat, arg_max(lon, ts_unix) AS end_lon FROM traj "
        "GROUP BY rank, side, mmsi, vessel_label, event_unix",
    )
    q["event_report"] = with_ctes(
        "wevent",
        "SELECT mmsi_a, mmsi_b, coalesce(nullif(name_a, ''), 'Unknown') AS vessel_a, "
        "coalesce(nullif(name_b, ''), 'Unknown') AS vessel_b, event_unix, "
        "strftime(make_timestamp(event_unix * 1000000), '%Y-%m-%d %H:%M:%S') || ' UTC' AS timestamp_utc, "
        "round(event_lat, 6) AS latitude, round(event_lon, 6) AS longitude, round(distance_nm * 1.852e3, 1) AS distance_m, "
        "round(distance_nm, 4) AS distance_nm, round(collision_score, 1) AS collision_score FROM wevent",
    )
    q["stage_counts"] = _stage_counts()
    return q
