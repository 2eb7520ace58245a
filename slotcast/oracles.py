"""The registered queries once more as plain SQL over the raw tables.

Written independently of the operators, in the naive way: shifted self-joins, brute-force
neighbour search, one aggregate per encoding. ``sql(final)`` prepends the common table
expressions ``final`` refers to.
"""

from __future__ import annotations


import re

EPS = "1e-9"
TIE = "3.14159e-11"
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE) + {TIE}, {digits}) + 0.0 AS {name or expr.split('.')[-1]}"


def rr(*columns: str) -> str:
    return ", ".join(r(c) for c in columns)


def _char(i: str) -> str:
    return f"substr('{ALPHABET}', CAST(1 + {i} AS INT), 1)"


def _bits(start: int, count: int) -> str:
    return " + ".join(f"(((v >> {start - 2 * j}) & 1) << {count - 1 - j})" for j in range(count))


def _from_log(x: str) -> str:
    return f"greatest(least(exp({x}), 1.0), 1e-6)"


def bucket(x: str) -> str:
    return f"CASE WHEN {x} < 0.03 THEN 0 WHEN {x} < 0.07 THEN 1 WHEN {x} < 0.15 THEN 2 ELSE 3 END"


def r2(y: str, p: str) -> str:
    return (f"CASE WHEN var_pop({y}) > 0 THEN 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*))"
            f" WHEN sum(({y} - {p}) * ({y} - {p})) = 0 THEN 1.0 WHEN count(*) > 0 THEN 0.0 END")


def mode(column: str, by: list[str]) -> str:
    """Most frequent value per group of the training rows, the smaller one on ties."""
    keys = ", ".join(by)
    ranked = f"row_number() OVER ({f'PARTITION BY {keys} ' if by else ''}ORDER BY count(*) DESC, {column})"
    return (f"(SELECT {keys + ', ' if by else ''}{column} AS v FROM (SELECT {keys + ', ' if by else ''}{column}, {ranked} AS k FROM train "
            f"WHERE {column} IS NOT NULL GROUP BY {keys + ', ' if by else ''}{column}) WHERE k = 1)")


STACKED = ["oof_a", "oof_b", "oof_forest", "oof_c", "geohash_te", "minute_of_day"]


def ridge(source: str, keys: str) -> str:
    """WITH clauses up to ``solved``: keys, w_<feature> and intercept by elimination on covariances."""
    k = len(STACKED)
    cells = [f"covar_pop({a}, {b}) * count(*) {'+ alpha' if i == j else ''} AS a{i}{j}"
             for i, a in enumerate(STACKED) for j, b in enumerate(STACKED)]
    cells += [f"covar_pop({a}, y_log) * count(*) AS b{i}" for i, a in enumerate(STACKED)]
    means = [f"avg({a}) AS m{i}" for i, a in enumerate([*STACKED, "y_log"])]
    group = f"{keys}" if "alpha" in keys else f"{keys}, alpha"
    parts = [f"source AS ({source})", f"e0 AS (SELECT {group}, {', '.join([*cells, *means])} FROM source GROUP BY {group})"]
    kept = ", ".join([group, *[f"m{i}" for i in range(k + 1)]])
    for s in range(k):  # row s leaves every other row without column s
        new = [f"a{i}{j}" + (f" - a{i}{s} / a{s}{s} * a{s}{j}" if i != s else "") + f" AS a{i}{j}" for i in range(k) for j in range(k)]
        new += [f"b{i}" + (f" - a{i}{s} / a{s}{s} * b{s}" if i != s else "") + f" AS b{i}" for i in range(k)]
        parts.append(f"e{s + 1} AS (SELECT {kept}, {', '.join(new)} FROM e{s})")
    weights = ", ".join(f"b{i} / a{i}{i} AS w_{f}" for i, f in enumerate(STACKED))
    intercept = f"m{k} - " + " - ".join(f"b{i} / a{i}{i} * m{i}" for i in range(k))
    parts.append(f"solved AS (SELECT {group}, {weights}, {intercept} AS intercept FROM e{k})")
    return "WITH " + ",\n".join(parts)


CTE: dict[str, str] = {
    "obs": f"""
        WITH e AS (
          SELECT user_id, value, event_type, CASE WHEN day(ts) <= 15 THEN 48 ELSE 49 END AS day,
                 CAST(hour(ts) * 60 + minute(ts) - minute(ts) % 15 AS INT) AS slot,
                 CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS kk
          FROM events
        ), a AS (
          SELECT user_id, day, slot, round(least(greatest(avg(value) / 500, 1e-6), 1.0), 8) AS demand,
                 min(event_type) AS et, min(kk) AS kmin
          FROM e GROUP BY user_id, day, slot
        )
        SELECT CAST((user_id * 2 + day - 48) * 1440 + slot AS BIGINT) AS Index,
               concat({_char('(22 + floor(user_id / 1024000)) % 32')}, {_char('(21 + floor(user_id / 32000)) % 32')}, {_char('floor(user_id / 1000) % 32')}, {_char('floor(user_id / 100) % 10')},
                      {_char('floor(user_id / 10) % 10')}, {_char('user_id % 10')}) AS geohash,
               day, concat(CAST(CAST(floor(slot / 60) AS INT) AS VARCHAR), ':', CAST(slot % 60 AS VARCHAR)) AS timestamp,
               CASE user_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Highway' WHEN 2 THEN 'Highway'
                    WHEN 3 THEN 'Residential' ELSE 'Street' END AS RoadType,
               CAST(1 + user_id % 5 AS INT) AS NumberofLanes,
               CASE WHEN user_id % 2 = 0 THEN 'Allowed' ELSE 'Not Allowed' END AS LargeVehicles,
               CASE WHEN user_id % 3 = 0 THEN 'Yes' ELSE 'No' END AS Landmarks,
               CASE WHEN kmin % 20 = 0 THEN NULL ELSE CAST(kmin AS DOUBLE) / 2 END AS Temperature,
               CASE et WHEN 'click' THEN 'Sunny' WHEN 'error' THEN NULL WHEN 'purchase' THEN 'Rainy'
                    WHEN 'signup' THEN 'Snowy' ELSE 'Foggy' END AS Weather,
               demand,
               CASE WHEN day = 48 AND user_id % 37 <> 0 AND user_id % 41 <> 1 THEN 'train'
                    WHEN day = 49 AND slot <= 120 AND user_id % 37 <> 0 THEN 'train'
                    WHEN day = 49 AND slot > 120 THEN 'test' END AS split
        FROM a""",
    "base": """
        SELECT *, CAST(split_part(timestamp, ':', 1) AS INT) AS hour, CAST(split_part(timestamp, ':', 2) AS INT) AS minute,
               CAST(split_part(timestamp, ':', 1) AS INT) * 60 + CAST(split_part(timestamp, ':', 2) AS INT) AS s
        FROM obs""",
    "train": "SELECT * FROM base WHERE split = 'train'",
    "test": "SELECT * EXCLUDE (demand) FROM base WHERE split = 'test'",
    "h": "SELECT * FROM train WHERE day = 48",
    "t": "SELECT * FROM train WHERE day = 49",
    "allrows": """
        SELECT Index, geohash, day, s, hour, demand, false AS is_test FROM train
        UNION ALL SELECT Index, geohash, day, s, hour, NULL, true FROM test""",
    "prof": "SELECT geohash, s, hour, avg(demand) AS v, sum(demand) AS total, count(*) AS n FROM h GROUP BY ALL",
    "gm": "SELECT avg(demand) AS gm, count(DISTINCT s) AS n_slots FROM h",
    "sm": "SELECT s, avg(demand) AS sm FROM h GROUP BY s",
    "gh": f"""
        SELECT geohash, count(*) AS n, avg(demand) AS mean, coalesce(stddev_samp(demand), 0) AS std,
               coalesce(stddev_samp(demand), 0) / (avg(demand) + {EPS}) AS cv, sum(demand) AS total,
               ln(avg(demand) + {EPS}) AS log_mean,
               quantile_cont(demand, 0.1) AS p10, quantile_cont(demand, 0.9) AS p90,
               avg(demand) FILTER (hour < 6) AS night_mean,
               avg(demand) FILTER (hour >= 7 AND hour < 10) AS peak_am_mean,
               avg(demand) FILTER (hour >= 10 AND hour < 14) AS midday_mean,
               avg(demand) FILTER (hour >= 16 AND hour < 20) AS peak_pm_mean
        FROM h GROUP BY geohash""",
    "ghh0": "SELECT geohash, hour, sum(demand) AS hs, count(*) AS hc, avg(demand) AS hm FROM h GROUP BY ALL",
    "ghh": """
        SELECT *, (rank() OVER (PARTITION BY geohash ORDER BY hm)
                   + (count(*) OVER (PARTITION BY geohash, hm) - 1) / 2.0)
                  / count(*) OVER (PARTITION BY geohash) AS hr
        FROM ghh0""",
    "px5": "SELECT substr(geohash, 1, 5) AS px, avg(demand) AS m FROM h GROUP BY 1",
    "px4": "SELECT substr(geohash, 1, 4) AS px, avg(demand) AS m FROM h GROUP BY 1",
    "px5s": "SELECT substr(geohash, 1, 5) AS px, s, avg(demand) AS m FROM h GROUP BY 1, 2",
    "px4s": "SELECT substr(geohash, 1, 4) AS px, s, avg(demand) AS m FROM h GROUP BY 1, 2",
    "vel0": "SELECT geohash, s, v, v - lag(v, 2) OVER (PARTITION BY geohash ORDER BY s) AS vel FROM prof",
    "dyn": """
        SELECT geohash, s, coalesce(vel, 0.0) AS velocity,
               coalesce(vel - lag(vel, 2) OVER (PARTITION BY geohash ORDER BY s), 0.0) AS acceleration,
               (rank() OVER (PARTITION BY geohash ORDER BY v) + (count(*) OVER (PARTITION BY geohash, v) - 1) / 2.0)
               / count(*) OVER (PARTITION BY geohash) AS rank_in_day
        FROM vel0""",
    "keys": """
        SELECT geohash, CASE WHEN max(CASE WHEN NOT is_test AND day = 48 THEN 1 ELSE 0 END) = 1 THEN 'warm'
                             WHEN max(CASE WHEN NOT is_test THEN 1 ELSE 0 END) = 1 THEN 'target_only'
                             ELSE 'cold' END AS key_class
        FROM allrows GROUP BY geohash""",
    "number": "SELECT geohash, " + " + ".join(
        f"(CAST(instr('{ALPHABET}', substr(geohash, {i + 1}, 1)) - 1 AS BIGINT) << {25 - 5 * i})" for i in range(6)
    ) + " AS v FROM (SELECT DISTINCT geohash FROM base)",
    "cell": f"SELECT geohash, {_bits(28, 15)} AS lat_i, {_bits(29, 15)} AS lon_i FROM number",
    "latlon": """
        SELECT geohash, -90 + (lat_i + 0.5) * 180.0 / 32768 AS lat, -180 + (lon_i + 0.5) * 360.0 / 32768 AS lon FROM cell""",
    "centres": """
        SELECT b.NumberofLanes - 1 AS cluster, avg(l.lat) AS lat, avg(l.lon) AS lon
        FROM (SELECT DISTINCT geohash, NumberofLanes FROM base) b JOIN latlon l ON l.geohash = b.geohash GROUP BY 1""",
    "pairs": """
        SELECT q.geohash, d.geohash AS neighbor, qk.key_class,
               4 * ((a.lat_i - b.lat_i) * (a.lat_i - b.lat_i) + 4 * (a.lon_i - b.lon_i) * (a.lon_i - b.lon_i)) AS dist2
        FROM keys q JOIN keys qk ON q.geohash = qk.geohash JOIN keys d ON d.key_class = 'warm' AND d.geohash <> q.geohash
        JOIN cell a ON a.geohash = q.geohash JOIN cell b ON b.geohash = d.geohash
        WHERE q.key_class <> 'target_only'""",
    "edges": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY geohash ORDER BY dist2, neighbor) AS rank FROM pairs)
        WHERE rank <= CASE WHEN key_class = 'warm' THEN 5 ELSE 3 END""",
    "nb": "SELECT e.geohash, p.s, avg(p.v) AS v FROM edges e JOIN prof p ON p.geohash = e.neighbor GROUP BY ALL",
    "look": """
        SELECT geohash, s, v FROM prof
        UNION ALL SELECT nb.geohash, nb.s, nb.v FROM nb JOIN keys k ON k.geohash = nb.geohash AND k.key_class = 'cold'""",
    "same": """
        SELECT a.Index, a.geohash, a.s, a.day, a.is_test, k.key_class,
               coalesce(l.v, sm.sm, gm.gm) AS genuine,
               coalesce((lo.v + hi.v) / 2, lo.v, hi.v, gh.mean, sm.sm, gm.gm) AS proxy
        FROM allrows a JOIN keys k ON k.geohash = a.geohash CROSS JOIN gm
        LEFT JOIN look l ON l.geohash = a.geohash AND l.s = a.s LEFT JOIN sm ON sm.s = a.s
        LEFT JOIN prof lo ON lo.geohash = a.geohash AND lo.s = a.s - 15
        LEFT JOIN prof hi ON hi.geohash = a.geohash AND hi.s = a.s + 15
        LEFT JOIN gh ON gh.geohash = a.geohash""",
    "shifted": """
        SELECT a.Index, o.off, a.s + o.off AS tgt,
               coalesce(l.v, sm.sm, gm.gm) AS genuine, coalesce(gh.mean, gm.gm) AS own, gm.gm
        FROM allrows a CROSS JOIN (VALUES (-60), (-30), (-15), (15), (30), (60)) o(off) CROSS JOIN gm
        LEFT JOIN look l ON l.geohash = a.geohash AND l.s = greatest(a.s + o.off, 0)
        LEFT JOIN sm ON sm.s = greatest(a.s + o.off, 0) LEFT JOIN gh ON gh.geohash = a.geohash""",
    "lags": """
        SELECT Index,
               (max(CASE WHEN off = -15 THEN CASE WHEN tgt < 0 THEN gm ELSE genuine END END)
                + max(CASE WHEN off = 15 THEN genuine END)) / 2 AS nearby,
               max(CASE WHEN off = -60 THEN CASE WHEN tgt < 0 THEN own ELSE genuine END END) AS m60,
               max(CASE WHEN off = -30 THEN CASE WHEN tgt < 0 THEN own ELSE genuine END END) AS m30,
               max(CASE WHEN off = 30 THEN genuine END) AS p30, max(CASE WHEN off = 60 THEN genuine END) AS p60
        FROM shifted GROUP BY Index""",
    "feat": f"""
        SELECT a.*, same.key_class,
               CASE WHEN a.day = 48 AND NOT a.is_test THEN same.proxy ELSE same.genuine END AS demand_d48_same_slot,
               lags.nearby AS demand_d48_nearby_slots, lags.m60 AS demand_d48_slot_m60, lags.m30 AS demand_d48_slot_m30,
               lags.p30 AS demand_d48_slot_p30, lags.p60 AS demand_d48_slot_p60,
               coalesce(nb.v, sm.sm, gm.gm) AS demand_d48_spatial_neighbor_slot,
               coalesce(gh.mean, sm.sm, gm.gm) AS demand_d48_geohash_mean,
               coalesce(gh.std, 0.0) AS demand_d48_geohash_std, coalesce(gh.cv, 0.0) AS demand_d48_geohash_cv,
               coalesce(gh.log_mean, ln(gm.gm + {EPS})) AS demand_d48_log_geohash_mean,
               coalesce(gh.total, gm.gm * gm.n_slots) AS demand_d48_day_total,
               coalesce(gh.night_mean, gm.gm) AS demand_d48_night_mean,
               coalesce(gh.peak_am_mean, gm.gm) AS demand_d48_peak_am_mean,
               coalesce(gh.midday_mean, gm.gm) AS demand_d48_midday_mean,
               coalesce(gh.peak_pm_mean, gm.gm) AS demand_d48_peak_pm_mean,
               coalesce(gh.p10, gm.gm * 0.1) AS demand_d48_geohash_p10,
               coalesce(gh.p90, gm.gm * 2.0) AS demand_d48_geohash_p90,
               coalesce(sm.sm / (gm.gm + {EPS}), 1.0) AS slot_shape,
               coalesce(sm.sm / (gm.gm + {EPS}), 1.0) * coalesce(gh.mean, sm.sm, gm.gm) AS demand_d48_expected,
               CASE WHEN a.day = 48 AND NOT a.is_test
                    THEN CASE WHEN ghh.hc > 1 THEN (ghh.hs - a.demand) / (ghh.hc - 1) ELSE coalesce(gh.mean, gm.gm) END
                    ELSE coalesce(ghh.hm, gh.mean, gm.gm) END AS demand_d48_gh_hour_mean,
               coalesce(ghh.hr, 0.5) AS demand_d48_gh_hour_rank,
               coalesce(dyn.velocity, 0.0) AS demand_d48_velocity,
               coalesce(dyn.acceleration, 0.0) AS demand_d48_acceleration,
               coalesce(dyn.rank_in_day, 0.5) AS demand_d48_rank_in_day,
               coalesce(px5.m, gm.gm) AS demand_d48_prefix5_mean, coalesce(px4.m, gm.gm) AS demand_d48_prefix4_mean,
               coalesce(px5s.m, sm.sm, gm.gm) AS demand_d48_prefix5_slot_mean,
               coalesce(px4s.m, sm.sm, gm.gm) AS demand_d48_prefix4_slot_mean
        FROM allrows a CROSS JOIN gm JOIN same ON same.Index = a.Index JOIN lags ON lags.Index = a.Index
        LEFT JOIN sm ON sm.s = a.s LEFT JOIN gh ON gh.geohash = a.geohash
        LEFT JOIN nb ON nb.geohash = a.geohash AND nb.s = a.s
        LEFT JOIN ghh ON ghh.geohash = a.geohash AND ghh.hour = a.hour
        LEFT JOIN dyn ON dyn.geohash = a.geohash AND dyn.s = a.s
        LEFT JOIN px5 ON px5.px = substr(a.geohash, 1, 5) LEFT JOIN px4 ON px4.px = substr(a.geohash, 1, 4)
        LEFT JOIN px5s ON px5s.px = substr(a.geohash, 1, 5) AND px5s.s = a.s
        LEFT JOIN px4s ON px4s.px = substr(a.geohash, 1, 4) AND px4s.s = a.s""",
    "feat2": f"""
        SELECT *, ln(greatest(demand_d48_same_slot, {EPS})) AS log_demand_d48_same_slot,
               demand_d48_same_slot / (demand_d48_geohash_mean + {EPS}) AS demand_d48_relative_slot,
               (demand_d48_same_slot - demand_d48_geohash_mean) / (demand_d48_geohash_std + 1e-3) AS demand_d48_zscore
        FROM feat""",
    "td": "SELECT geohash, sum(demand) AS ds, count(*) AS dc, avg(demand) AS dm, arg_max(demand, s) AS dl FROM t GROUP BY geohash",
    "tgm": "SELECT avg(demand) AS tgm FROM t",
    "anchors": """
        SELECT a.Index, a.geohash, a.day, a.is_test,
               CASE WHEN a.day = 49 AND NOT a.is_test
                    THEN CASE WHEN td.dc > 1 THEN (td.ds - a.demand) / (td.dc - 1) ELSE tgm.tgm END
                    ELSE coalesce(td.dm, tgm.tgm) END AS demand_d49_morning_mean,
               coalesce(td.dl, tgm.tgm) AS demand_d49_last_known
        FROM allrows a CROSS JOIN tgm LEFT JOIN td ON td.geohash = a.geohash""",
    "ylog": "SELECT *, ln(demand) AS y, substr(geohash, 1, 4) AS px, CASE WHEN day = 49 THEN 0 ELSE -1 END AS fold FROM train",
    "prior": "SELECT avg(y) AS prior FROM ylog",
    "enc_k": "SELECT geohash, fold, sum(y) AS sy, count(*) AS c FROM ylog GROUP BY ALL",
    "rowfold": """
        SELECT Index, geohash, substr(geohash, 1, 4) AS px, hour, CASE WHEN is_test OR day = 48 THEN -1 ELSE 0 END AS fold
        FROM allrows""",
    "te_k": """
        SELECT r.Index, (coalesce(sum(y.y), 0) + 30 * any_value(prior.prior)) / (count(y.y) + 30) AS te
        FROM rowfold r CROSS JOIN prior LEFT JOIN ylog y ON y.geohash = r.geohash AND (r.fold = -1 OR y.fold <> r.fold)
        GROUP BY r.Index""",
    "te_kh": """
        SELECT r.Index, (coalesce(sum(y.y), 0) + 30 * any_value(prior.prior)) / (count(y.y) + 30) AS te
        FROM rowfold r CROSS JOIN prior
        LEFT JOIN ylog y ON y.geohash = r.geohash AND y.hour = r.hour AND (r.fold = -1 OR y.fold <> r.fold)
        GROUP BY r.Index""",
    "px_groups": "SELECT px, fold, sum(y) AS sy, count(*) AS c FROM ylog GROUP BY ALL",
    "te_px": """
        SELECT r.Index, (coalesce(sum(g.sy), 0) + 30 * any_value(prior.prior)) / (coalesce(sum(g.c), 0) + 30) AS te
        FROM rowfold r CROSS JOIN prior LEFT JOIN px_groups g ON g.px = r.px AND (r.fold = -1 OR g.fold <> r.fold)
        GROUP BY r.Index""",
    "temp": """
        SELECT b.Index, coalesce(b.Temperature, l1.m, l2.m, l3.m) AS Temperature
        FROM (SELECT Index, geohash, hour, Temperature FROM train UNION ALL SELECT Index, geohash, hour, Temperature FROM test) b
        LEFT JOIN (SELECT geohash, hour, median(Temperature) AS m FROM train GROUP BY ALL) l1
               ON l1.geohash = b.geohash AND l1.hour = b.hour
        LEFT JOIN (SELECT geohash, median(Temperature) AS m FROM train GROUP BY ALL) l2 ON l2.geohash = b.geohash
        CROSS JOIN (SELECT median(Temperature) AS m FROM train) l3""",
    "attrs": """
        SELECT Index, RoadType, NumberofLanes, LargeVehicles, Landmarks, Temperature, Weather, minute FROM train
        UNION ALL SELECT Index, RoadType, NumberofLanes, LargeVehicles, Landmarks, Temperature, Weather, minute FROM test""",
    "oof": f"""
        SELECT a.Index, a.geohash, a.hour, a.s, a.demand, ln(a.demand) AS y_log, CASE WHEN a.day = 49 THEN 0 ELSE -1 END AS fold,
               CASE WHEN a.day = 49 THEN ln(coalesce(p.v, sm.sm, gm.gm)) END AS oof_a,
               CASE WHEN a.day = 49 THEN ln(coalesce(sm.sm / (gm.gm + {EPS}), 1.0) * coalesce(gh.mean, sm.sm, gm.gm)) END AS oof_b,
               CASE WHEN a.day = 49 THEN ln(coalesce(gh.mean, sm.sm, gm.gm)) END AS oof_forest,
               CASE WHEN a.day = 49 THEN ln(coalesce(ghh0.hm, gh.mean, gm.gm)) END AS oof_c
        FROM train a CROSS JOIN gm LEFT JOIN sm ON sm.s = a.s LEFT JOIN gh ON gh.geohash = a.geohash
        LEFT JOIN prof p ON p.geohash = a.geohash AND p.s = a.s
        LEFT JOIN ghh0 ON ghh0.geohash = a.geohash AND ghh0.hour = a.hour""",
    "val": f"""
        SELECT Index, geohash, hour, y_log, 0.1 * oof_a + 0.2 * oof_b + 0.6 * oof_forest + 0.1 * oof_c AS p_log,
               {_from_log('y_log')} AS y, {_from_log('0.1 * oof_a + 0.2 * oof_b + 0.6 * oof_forest + 0.1 * oof_c')} AS p
        FROM oof WHERE fold = 0""",
    "valb": f"SELECT *, {bucket('y')} AS b, {bucket('p')} AS pb, y_log - p_log AS res FROM val",
    "models": """
        SELECT 'oof_a' AS model, y_log, oof_a AS p_log FROM oof WHERE fold = 0
        UNION ALL SELECT 'oof_b', y_log, oof_b FROM oof WHERE fold = 0
        UNION ALL SELECT 'oof_forest', y_log, oof_forest FROM oof WHERE fold = 0
        UNION ALL SELECT 'oof_c', y_log, oof_c FROM oof WHERE fold = 0""",
    "labels4": "SELECT * FROM (VALUES (0, 'very_low (<0.03)'), (1, 'low (0.03-0.07)'), (2, 'medium (0.07-0.15)'), (3, 'high (>0.15)')) l(bucket, label)",
    "bm": f"""
        SELECT b AS bucket, count(*) AS n, {r2('y', 'p')} AS r2, avg(abs(y - p)) AS mae,
               avg(CASE WHEN pb = b THEN 1.0 ELSE 0.0 END) AS acc FROM valb GROUP BY b""",
    "bmetrics": """
        SELECT l.bucket, l.label, coalesce(bm.n, 0) AS n, CASE WHEN bm.n >= 2 THEN bm.r2 END AS r2,
               CASE WHEN bm.n >= 2 THEN bm.mae END AS mae, CASE WHEN bm.n >= 2 THEN bm.acc END AS acc
        FROM labels4 l LEFT JOIN bm ON bm.bucket = l.bucket""",
    "cm": """
        SELECT l.bucket, count(v.b) FILTER (v.pb = 0) AS p0, count(v.b) FILTER (v.pb = 1) AS p1,
               count(v.b) FILTER (v.pb = 2) AS p2, count(v.b) FILTER (v.pb = 3) AS p3
        FROM labels4 l LEFT JOIN valb v ON v.b = l.bucket GROUP BY l.bucket""",
    "diag": """
        SELECT bucket, CASE WHEN p0 + p1 + p2 + p3 > 0 THEN
               CASE bucket WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END * 1.0 / (p0 + p1 + p2 + p3) END AS acc
        FROM cm""",
    "err": "SELECT geohash, avg(abs(y_log - p_log)) AS mae FROM val GROUP BY geohash",
    "byhour": f"""
        SELECT h.hour, coalesce(x.n, 0) AS n, CASE WHEN x.n >= 2 THEN x.r2 END AS r2
        FROM (SELECT CAST(range AS INT) AS hour FROM range(24)) h
        LEFT JOIN (SELECT hour, count(*) AS n, {r2('y', 'p')} AS r2 FROM val GROUP BY hour) x ON x.hour = h.hour""",
    "simplex": """
        SELECT i, j, l, {n} - i - j - l AS m FROM range({n} + 1) a(i), range({n} + 1) b(j), range({n} + 1) c(l)
        WHERE i + j + l <= {n}""".replace("{n}", "20"),
    "cand": f"""
        SELECT i, j, l, m, {r2('y', 'p')} AS r2,
               (i * i + j * j + l * l + m * m) / 400.0 AS sq
        FROM (SELECT s.*, {_from_log('o.y_log')} AS y,
                     {_from_log('(s.i * o.oof_a + s.j * o.oof_b + s.l * o.oof_forest + s.m * o.oof_c) / 20.0')} AS p
              FROM simplex s CROSS JOIN (SELECT * FROM oof WHERE fold = 0) o)
        GROUP BY i, j, l, m""",
    "best": """
        SELECT i / 20.0 AS w_oof_a, j / 20.0 AS w_oof_b, l / 20.0 AS w_oof_forest, m / 20.0 AS w_oof_c, r2, r2 - 0.01 * sq AS score
        FROM cand ORDER BY score DESC, i, j, l, m LIMIT 1""",
    "gfold": """
        SELECT geohash, n, CAST(fold AS INT) AS fold FROM (
          WITH RECURSIVE o AS (SELECT geohash, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, geohash) AS i FROM train GROUP BY geohash),
          p(i, geohash, n, fold, loads) AS (
            SELECT CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), CAST(-1 AS BIGINT), CAST([0, 0, 0, 0, 0] AS BIGINT[])
            UNION ALL
            SELECT o.i, o.geohash, o.n, CAST(list_position(p.loads, list_min(p.loads)) - 1 AS BIGINT),
                   list_transform(p.loads, lambda x, k: x + CASE WHEN k = list_position(p.loads, list_min(p.loads)) THEN o.n ELSE 0 END)
            FROM p JOIN o ON o.i = p.i + 1)
          SELECT * FROM p WHERE i > 0) packed""",
    "stackrows": """
        SELECT o.Index, g.fold AS fold, o.y_log, o.oof_a, o.oof_b, o.oof_forest, o.oof_c, k.te AS geohash_te, o.s AS minute_of_day
        FROM oof o JOIN te_k k ON k.Index = o.Index JOIN gfold g ON g.geohash = o.geohash WHERE o.fold = 0""",
    "shifts": f"""
        SELECT i * 0.7 / 70 AS log_shift, {r2('y', 'p')} AS r2
        FROM (SELECT s.i, v.y, {_from_log('v.p_log + s.i * 0.7 / 70')} AS p FROM val v CROSS JOIN range(71) s(i)) GROUP BY i""",
    "cluster": "SELECT DISTINCT geohash, substr(geohash, 1, 5) AS geohash_cluster FROM base WHERE split IN ('train', 'test')",
    "cls": "SELECT c.geohash_cluster, h.s, avg(h.demand) AS m FROM h JOIN cluster c ON c.geohash = h.geohash GROUP BY ALL",
    "runs": """
        SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS lb,
               value / 1000 AS blend_calib, value / 500 AS blend_raw, event_type AS note,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE value / 200 END AS et,
               user_id AS n_feat, event_id % 4 <> 0 AS weighted
        FROM events WHERE event_id % 11 <> 0 AND event_id % 13 <> 0""",
}


def _needed(text: str) -> list[str]:
    """Names of the expressions a text refers to, dependencies first."""
    order: list[str] = []

    def visit(body: str) -> None:
        used = set(re.findall(r"(?:FROM|JOIN|,)\s+([a-z_][a-z0-9_]*)", body))
        for name in CTE:
            if name in used and name not in order:
                visit(CTE[name])
                if name not in order:
                    order.append(name)

    visit(text)
    return order


def sql(final: str) -> str:
    parts = [f"{name} AS ({CTE[name]})" for name in _needed(final)]
    if parts and final.lstrip().startswith("WITH "):  # the text has expressions of its own
        return "WITH " + ",\n".join(parts) + ",\n" + final.lstrip().removeprefix("WITH ")
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final
