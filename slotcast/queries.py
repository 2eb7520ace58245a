"""Registry: every operator as a query over a table folder, with its plain SQL twin.

A name starting with ``~`` in ``out`` is rounded, like ``r`` does on the SQL side.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import oracles as O
from slotcast import spec as S
from slotcast.functions import geo
from slotcast.functions import scalar as X
from slotcast.oracles import r, rr, sql
from slotcast.operators import blend as B
from slotcast.operators import boosting, search
from slotcast.operators import categories, clusters, encoding, folds, impute, knn, stacking
from slotcast.operators import evaluate as E
from slotcast.operators import models as M
from slotcast.operators import profile as P
from slotcast.operators import quality as Q
from slotcast.plans import feature_matrix as FM
from slotcast.plans import history as H
from slotcast.plans import reports, target_day
from slotcast.session import materialize, scratch_path, tuned
from slotcast.sources import events_view as V
from slotcast.sources import sinks, stored as ST, tables
from slotcast.spec import DEFAULT as SP

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, final: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with tuned(spark):
                return fn(spark, sf_dir)

        QUERIES[name] = run
        if final is not None:
            ORACLES[name] = sql(final)
        return fn

    return register


def out(df: DataFrame, *columns: str) -> DataFrame:
    exprs = []
    for c in columns:
        expr, _, name = c.removeprefix("~").rpartition(" as ")
        expr = expr or name
        exprs.append(f"{X.rounded(expr) if c.startswith('~') else expr} as `{name}`")
    return df.selectExpr(*exprs)


def split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return V.labelled(spark, d), V.unlabelled(spark, d)


def stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return V.stored(spark, d)


def history_rows(spark: SparkSession, d: str) -> DataFrame:
    return P.on_day(V.labelled(spark, d), 48)


def profile(spark: SparkSession, d: str) -> DataFrame:
    return P.slot_profile(history_rows(spark, d))


def attached(spark: SparkSession, d: str, *features: str) -> DataFrame:
    return H.attach_cell_features(*stored(spark, d), list(features))


ROWS = "Index, geohash, s AS minute_of_day"
ID = ("Index", "geohash", "minute_of_day")

# --- sources and sinks -----------------------------------------------------------------

RAW = ["Index", "geohash", "day", "timestamp", "RoadType", "NumberofLanes", "LargeVehicles", "Landmarks",
       "Temperature", "Weather"]


@query("scan_observations", f"SELECT {', '.join(RAW)}, demand FROM train")
def _(spark, d):
    path = scratch_path(spark, "observations")
    absent = {"RoadType": "n/a", "Temperature": "<NA>", "Weather": "#N/A"}
    texts = [f"coalesce(cast({c} as string), '{absent[c]}') as {c}" if c in absent else c for c in RAW[::-1]]
    V.labelled(spark, d).selectExpr("demand", *texts, "'x' as other").write.csv(path, header=True)
    return tables.read_observations(spark, path)


@query("scan_targets", f"SELECT {', '.join(RAW)} FROM test")
def _(spark, d):
    path = scratch_path(spark, "targets")
    absent = {"RoadType": "#NA", "Temperature": "-nan", "Weather": "1.#QNAN"}
    texts = [f"coalesce(cast({c} as string), '{absent[c]}') as {c}" if c in absent else c for c in [*RAW[3:], *RAW[:3]]]
    V.unlabelled(spark, d).selectExpr(*texts).write.csv(path, header=True)
    return tables.read_observations(spark, path, labelled=False)


def naive_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Yesterday's slot shape times the location's level, for the rows to predict."""
    prof = profile(spark, d)
    rows = V.unlabelled(spark, d)
    return (
        rows.join(P.slot_shape(prof), "minute_of_day", "left")
        .join(P.grouped(prof, ["geohash"], level=P.MEAN), "geohash", "left")
        .withColumn("overall", P.global_mean(prof).scalar())
        .selectExpr("*", "coalesce(slot_shape, 1D) * coalesce(level, overall) as demand")
    )


@query("predictions_out", f"""
    SELECT t.Index, {r(f'coalesce(sm.sm / (gm.gm + {O.EPS}), 1.0) * coalesce(gh.mean, gm.gm)', 'demand')}
    FROM test t CROSS JOIN gm LEFT JOIN sm ON sm.s = t.s LEFT JOIN gh ON gh.geohash = t.geohash""")
def _(spark, d):
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(naive_forecast(spark, d), path)
    return out(spark.read.schema("Index bigint, demand double").csv(path, header=True), "Index", "~demand")


STANDINS = ["oof_a", "oof_b", "oof_forest", "oof_c"]
WEIGHTS = {"oof_a": 0.1, "oof_b": 0.2, "oof_forest": 0.6, "oof_c": 0.1}


def oof(spark: SparkSession, d: str) -> DataFrame:
    """Deterministic stand-ins for model outputs: four history lookups on the log scale."""
    train, test = stored(spark, d)
    features = ["profile_or_slot", "demand_d48_expected", "demand_d48_geohash_mean", "hour_mean", "hour_fallback"]
    rows = H.attach_cell_features(train, test.where("false"), features)
    models = {"oof_a": "profile_or_slot", "oof_b": "demand_d48_expected", "oof_forest": "demand_d48_geohash_mean",
              "oof_c": "coalesce(hour_mean, hour_fallback)"}
    return (
        rows.where("not is_test").selectExpr("*", f"{X.temporal_fold('day')} as fold", "ln(demand) as y_log")
        .selectExpr("Index", "geohash", "hour", "minute_of_day", "demand", "y_log", "fold",
                    *[f"case when fold = 0 then ln({e}) end as {m}" for m, e in models.items()])
    )


def validation(spark: SparkSession, d: str) -> DataFrame:
    return B.reblend(oof(spark, d).where("fold = 0"), WEIGHTS, ("oof_a", "oof_b", 0.5))


@query("metrics_row", f"""
    SELECT {r(O.r2('y', 'p'), 'blend_oof_r2')}, count(*) AS n_val, (SELECT count(*) FROM oof WHERE fold = -1) AS n_train,
           0.6 AS w_forest FROM val""")
def _(spark, d):
    path = scratch_path(spark, "metrics")
    rows = materialize(oof(spark, d))
    blended = B.reblend(rows.where("fold = 0"), WEIGHTS, ("oof_a", "oof_b", 0.5))
    n_train = rows.where("fold = -1").agg(F.count("*")).scalar()
    document = E.r2_original_scale(blended).withColumn("n_train", n_train).selectExpr(
        "r2 as blend_oof_r2", "n as n_val", "n_train",
        "named_struct({}) as blend_weights".format(", ".join(f"'{m}', {w}D" for m, w in WEIGHTS.items())))
    sinks.write_json(document, path)
    stored = spark.read.schema(
        "blend_oof_r2 double, n_val bigint, n_train bigint, blend_weights struct<oof_forest: double>").json(path)
    return out(stored, "~blend_oof_r2", "n_val", "n_train", "blend_weights.oof_forest as w_forest")


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, 11 AS n_columns FROM train"
    for c in [*RAW, "demand"]))
def _(spark, d):
    return sinks.null_counts(V.labelled(spark, d).select(*RAW, "demand"))


@query("run_record", f"""
    SELECT model AS note, {r(O.r2(O._from_log('y_log'), O._from_log('p_log')), 'blend_raw')}, count(*) AS n_val,
           {r('avg(' + O._from_log('p_log') + ')', 'pred_mean')} FROM models GROUP BY model""")
def _(spark, d):
    path = scratch_path(spark, "runs")
    records = E.model_r2(materialize(oof(spark, d).where("fold = 0")), STANDINS).selectExpr(
        "model as note", "r2 as blend_raw", "n as n_val", "pred_mean")
    for model in STANDINS:
        sinks.append_run_record(records.where(f"note = '{model}'"), path)
    return out(tables.read_run_log(spark, path), "note", "~blend_raw", "n_val", "~pred_mean")


def run_log(spark: SparkSession, d: str) -> DataFrame:
    """Run log with one JSON line per event, some blank and some cut short, read back."""
    path = scratch_path(spark, "runlog")
    events = spark.read.parquet(f"{d}/events.parquet")
    record = """to_json(named_struct(
        'ts', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'lb', case when event_id % 5 <> 0 then value when event_id % 2 = 0 then 0D end,
        'blend_calib', value / 1000, 'blend_raw', value / 500, 'et', case when event_id % 4 <> 0 then value / 200 end,
        'w', case when event_id % 4 <> 0 then named_struct('lgbm', 0.25D, 'cat', 0D, 'et', 0.75D) end,
        'calib_ab', array(1D, 0D), 'n_feat', user_id, 'note', event_type))"""
    events.selectExpr(
        f"case when event_id % 11 = 0 then '' when event_id % 13 = 0 then substring({record}, 1, 40) else regexp_replace({record}, '\"lb\":0.0,', '\"lb\":\"n/a\",') end as value"
    ).write.text(path)
    return tables.read_run_log(spark, path)


@query("run_log_scan", f"""
    SELECT ts, {r('lb')}, {r('blend_calib')}, {r('blend_raw')}, {r('et')}, n_feat, note,
           {r('CASE WHEN weighted THEN 0.75 END', 'w_et')} FROM runs""")
def _(spark, d):
    return out(run_log(spark, d), "ts", "~lb", "~blend_calib", "~blend_raw", "~et", "n_feat", "note", "~w.et as w_et")


@query("run_log_missing", f"SELECT ts, {r('lb')}, note FROM runs")
def _(spark, d):
    missing = tables.read_run_log(spark, scratch_path(spark, "absent"))
    return out(missing.unionByName(run_log(spark, d)), "ts", "~lb", "note")


OOF_SQL = f"SELECT Index, fold, {r('y_log')}, {', '.join(r(m) for m in STANDINS)} FROM oof"
OOF_COLUMNS = ("Index", "fold", "~y_log", *[f"~{m}" for m in STANDINS])


def stored_oof(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "oof")
    frame = oof(spark, d).select("Index", "fold", "y_log", *STANDINS)
    sinks.write_oof(frame, path)
    return path, frame


@query("oof_table", OOF_SQL)
def _(spark, d):
    return out(spark.read.parquet(stored_oof(spark, d)[0]), *OOF_COLUMNS)


@query("oof_reload", OOF_SQL)
def _(spark, d):
    path, frame = stored_oof(spark, d)
    found = tables.read_optional(spark, path, frame.schema)
    absent = tables.read_optional(spark, scratch_path(spark, "absent"), frame.schema)
    return out(found.unionByName(absent), *OOF_COLUMNS)


# --- projections ----------------------------------------------------------------------

@query("parse_timestamps", "SELECT Index, timestamp, hour, minute, s AS minute_of_day FROM base")
def _(spark, d):
    return tables.with_time(V.observations(spark, d)).select("Index", "timestamp", "hour", "minute", "minute_of_day")


@query("geohash_decode", f"SELECT geohash, {r('lat', digits=9)}, {r('lon', digits=9)} FROM latlon")
def _(spark, d):
    return geo.decode(V.observations(spark, d)).selectExpr(
        "geohash", f"{X.rounded('lat', 9)} as lat", f"{X.rounded('lon', 9)} as lon")


@query("geohash_prefix", "SELECT Index, substr(geohash, 1, 5) AS prefix5, substr(geohash, 1, 4) AS prefix4 FROM base")
def _(spark, d):
    return V.observations(spark, d).selectExpr(
        "Index", "substring(geohash, 1, 5) as prefix5", "substring(geohash, 1, 4) as prefix4")


@query("encode_flags", """
    SELECT Index, CASE WHEN LargeVehicles = 'Allowed' THEN 1 ELSE 0 END AS large_vehicles,
           CASE WHEN Landmarks = 'Yes' THEN 1 ELSE 0 END AS landmarks FROM base""")
def _(spark, d):
    return out(V.observations(spark, d), "Index", f"{X.flag('LargeVehicles', S.LARGE_VEHICLES_ALLOWED)} as large_vehicles",
               f"{X.flag('Landmarks', S.LANDMARKS_YES)} as landmarks")


@query("missing_flags", "SELECT Index, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing" for c in ("Temperature", "Weather", "RoadType")) + " FROM base")
def _(spark, d):
    return V.observations(spark, d).selectExpr(
        "Index", *[f"{X.missing(c)} as {c}_missing" for c in ("Temperature", "Weather", "RoadType")])


@query("fill_unknown", "SELECT Index, coalesce(Weather, 'Unknown') AS Weather, coalesce(RoadType, 'Unknown') AS RoadType FROM base")
def _(spark, d):
    return V.observations(spark, d).selectExpr(
        "Index", f"{X.fill_unknown('Weather')} as Weather", f"{X.fill_unknown('RoadType')} as RoadType")


@query("lanes_cast", "SELECT Index, CAST(NumberofLanes AS INT) AS NumberofLanes FROM base")
def _(spark, d):
    text = V.observations(spark, d).selectExpr("Index", "cast(NumberofLanes as string) as NumberofLanes")
    return text.selectExpr("Index", f"{X.required_int('NumberofLanes', 'NumberofLanes')} as NumberofLanes")


@query("cyclic_features", "SELECT Index, " + ", ".join(
    r(f"{fn}(2 * pi() * {h} * s / 1440)", f"mod_{fn}{'' if h == 1 else h}") for h in (1, 2, 3) for fn in ("sin", "cos")
) + " FROM base")
def _(spark, d):
    rows = tables.with_time(V.observations(spark, d))
    return rows.selectExpr("Index", *[f"{X.rounded(e)} as {c}" for c, e in X.cyclic("minute_of_day").items()])


@query("log_target", f"SELECT Index, {r('ln(demand)', 'y_log')} FROM train")
def _(spark, d):
    return out(V.labelled(spark, d), "Index", f"~{X.log_value('demand')} as y_log")


@query("inverse_target", f"SELECT Index, {r(O._from_log('2 * ln(demand) + 3'), 'demand')} FROM train")
def _(spark, d):
    return out(V.labelled(spark, d), "Index", f"~{X.from_log('2 * ln(demand) + 3')} as demand")


@query("composite_key", "SELECT Index, concat(geohash, '_', CAST(hour AS VARCHAR)) AS geohash_hour FROM train")
def _(spark, d):
    return V.labelled(spark, d).selectExpr("Index", "concat_ws('_', geohash, hour) as geohash_hour")


@query("hour_from_slot", "SELECT Index, CAST(floor(s / 60) AS INT) AS hour FROM base")
def _(spark, d):
    return tables.with_time(V.observations(spark, d)).selectExpr("Index", f"{X.hour_of_slot('minute_of_day')} as hour")


@query("value_buckets", f"SELECT Index, {O.bucket('demand')} AS bucket, l.label FROM train JOIN labels4 l ON l.bucket = {O.bucket('demand')}")
def _(spark, d):
    index = X.bucket("demand")
    return V.labelled(spark, d).selectExpr("Index", f"{index} as bucket", f"{X.bucket_label(index)} as label")


@query("ordinal_encode", """
    SELECT t.Index, coalesce(a.code, (SELECT count(DISTINCT coalesce(RoadType, 'Unknown')) FROM train)) AS RoadType_code,
           coalesce(b.code, (SELECT count(DISTINCT coalesce(Weather, 'Unknown')) FROM train)) AS Weather_code
    FROM attrs t
    LEFT JOIN (SELECT DISTINCT coalesce(RoadType, 'Unknown') AS v, dense_rank() OVER (ORDER BY coalesce(RoadType, 'Unknown')) - 1 AS code FROM train) a
           ON a.v = coalesce(t.RoadType, 'Unknown')
    LEFT JOIN (SELECT DISTINCT coalesce(Weather, 'Unknown') AS v, dense_rank() OVER (ORDER BY coalesce(Weather, 'Unknown')) - 1 AS code FROM train) b
           ON b.v = coalesce(t.Weather, 'Unknown')""")
def _(spark, d):
    columns = ["Index", *[f"{X.fill_unknown(c)} as {c}" for c in ("RoadType", "Weather")]]
    train, test = (x.selectExpr(*columns) for x in split(spark, d))
    coded = categories.ordinal_encode(train, train.unionByName(test), ["RoadType", "Weather"])
    return coded.selectExpr("Index", "cast(RoadType_code as bigint) as RoadType_code", "cast(Weather_code as bigint) as Weather_code")


@query("numeric_coerce", f"""
    SELECT Index, coalesce(TRY_CAST(timestamp AS DOUBLE), 0.0) AS timestamp, coalesce(TRY_CAST(Weather AS DOUBLE), 0.0) AS Weather,
           coalesce(Temperature, 0.0) AS Temperature, CAST(NumberofLanes AS DOUBLE) AS NumberofLanes FROM base""")
def _(spark, d):
    return V.observations(spark, d).selectExpr(
        "Index", *[f"{X.to_number(c)} as {c}" for c in ("timestamp", "Weather", "Temperature", "NumberofLanes")])


@query("residuals", f"SELECT Index, {r('res', 'residual')}, {r('abs(res)', 'abs_residual')} FROM valb")
def _(spark, d):
    return out(validation(spark, d), "Index", "~y_log - p_log as residual", "~abs(y_log - p_log) as abs_residual")


@query("assign_folds", "SELECT Index, CASE WHEN day = 49 THEN 0 ELSE -1 END AS fold FROM train")
def _(spark, d):
    return V.labelled(spark, d).selectExpr("Index", f"{X.temporal_fold('day')} as fold")


@query("run_history", """
    SELECT substr(ts, 1, 16) AS ts, CASE WHEN lb IS NULL OR lb = 0 THEN '-' ELSE printf('%.2f', lb) END AS lb,
           printf('%.5f', blend_calib) AS blend_calib, printf('%.5f', blend_raw) AS blend_raw,
           CASE WHEN et IS NULL OR et = 0 THEN '-' ELSE printf('%.5f', et) END AS et,
           CASE WHEN weighted THEN '0.25/0.00/0.75' ELSE '-' END AS weights, '1.000,0.000' AS calibration,
           CAST(n_feat AS VARCHAR) AS n_feat, note FROM runs""")
def _(spark, d):
    return reports.run_history(run_log(spark, d)).select(
        "ts", "lb", "blend_calib", "blend_raw", "et", "weights", "calibration", "n_feat", "note")


# --- filters --------------------------------------------------------------------------

@query("split_by_day", "SELECT Index, geohash, day, demand, 'history' AS part FROM h UNION ALL SELECT Index, geohash, day, demand, 'target' FROM t")
def _(spark, d):
    train = V.labelled(spark, d)
    parts = [P.on_day(train, day).selectExpr("Index", "geohash", "day", "demand", f"'{name}' as part")
             for day, name in ((SP.history_day, "history"), (SP.target_day, "target"))]
    return parts[0].unionByName(parts[1])


@query("fold_split", "SELECT fold, count(*) AS n, count(oof_a) AS n_predicted FROM oof GROUP BY fold")
def _(spark, d):
    return P.grouped(oof(spark, d), ["fold"], n="count(*)", n_predicted="count(oof_a)")


# --- joins ----------------------------------------------------------------------------

@query("same_slot_lookup", f"SELECT {ROWS}, key_class, {r('genuine', 'same_slot')} FROM same WHERE day = 49")
def _(spark, d):
    return out(attached(spark, d, "same_slot_genuine").where("day = 49"), *ID, "key_class", "~same_slot_genuine as same_slot")


@query("proxy_slot_lookup", f"SELECT {ROWS}, {r('proxy', 'same_slot')} FROM same WHERE day = 48")
def _(spark, d):
    return out(attached(spark, d, "same_slot_proxy").where("day = 48"), *ID, "~same_slot_proxy as same_slot")


@query("nearby_slots", f"SELECT Index, {r('nearby', 'nearby_slots')} FROM lags")
def _(spark, d):
    return out(attached(spark, d, "demand_d48_nearby_slots"), "Index", "~demand_d48_nearby_slots as nearby_slots")


@query("slot_lags", f"SELECT Index, {rr('m60', 'm30', 'p30', 'p60')} FROM lags")
def _(spark, d):
    names = ("m60", "m30", "p30", "p60")
    return out(attached(spark, d, *[f"demand_d48_slot_{n}" for n in names]), "Index",
               *[f"~demand_d48_slot_{n} as {n}" for n in names])


ENTITY = ["demand_d48_geohash_mean", "demand_d48_geohash_std", "demand_d48_geohash_cv", "demand_d48_geohash_p10",
          "demand_d48_geohash_p90", "demand_d48_log_geohash_mean", "demand_d48_day_total", "demand_d48_night_mean",
          "demand_d48_peak_am_mean", "demand_d48_midday_mean", "demand_d48_peak_pm_mean"]


def feature_query(name: str, columns: list[str], source: str = "feat") -> None:
    """Rows with the named cell features against the naive feature table."""

    @query(name, f"SELECT {ROWS}, {rr(*columns)} FROM {source}")
    def _(spark, d):
        return out(attached(spark, d, *columns), *ID, *[f"~{c}" for c in columns])


feature_query("entity_profile_join", ENTITY)
feature_query("prefix_slot_join", ["demand_d48_prefix5_mean", "demand_d48_prefix4_mean",
                                   "demand_d48_prefix5_slot_mean", "demand_d48_prefix4_slot_mean"])
feature_query("spatial_lag", ["demand_d48_spatial_neighbor_slot"])
feature_query("expected_demand", ["slot_shape", "demand_d48_geohash_mean", "demand_d48_expected"])
feature_query("log_entity_mean", ["demand_d48_log_geohash_mean"])


@query("entity_hour_join", f"SELECT {ROWS}, {rr('demand_d48_gh_hour_mean', 'demand_d48_gh_hour_rank')} FROM feat WHERE day = 49")
def _(spark, d):
    rows = attached(spark, d, "hour_mean", "hour_fallback", "demand_d48_gh_hour_rank").where("day = 49")
    return out(rows, *ID, "~coalesce(hour_mean, hour_fallback) as demand_d48_gh_hour_mean", "~demand_d48_gh_hour_rank")


EDGE_SQL = f"SELECT geohash, neighbor, rank, {r('sqrt(dist2) * 180 / 65536', 'dist')} FROM edges WHERE key_class = "


@query("knn_warm", EDGE_SQL + "'warm'")
def _(spark, d):
    return out(knn.warm_neighbors(history_rows(spark, d)), "geohash", "neighbor", "cast(rank as bigint) as rank", "~dist")


@query("knn_cold", EDGE_SQL + "'cold'")
def _(spark, d):
    train, test = split(spark, d)
    edges = knn.cold_neighbors(H.cold_keys(train, test), P.on_day(train, SP.history_day))
    return out(edges, "geohash", "neighbor", "cast(rank as bigint) as rank", "~dist")


@query("cold_fill", f"""
    SELECT a.Index, a.geohash, a.s AS minute_of_day, {r('coalesce(nb.v, sm.sm, gm.gm)', 'filled')}
    FROM allrows a CROSS JOIN gm JOIN keys k ON k.geohash = a.geohash AND k.key_class = 'cold'
    LEFT JOIN nb ON nb.geohash = a.geohash AND nb.s = a.s LEFT JOIN sm ON sm.s = a.s""")
def _(spark, d):
    return out(attached(spark, d, "cold_fill").where("key_class = 'cold'"), *ID, "~cold_fill as filled")


@query("cold_keys", "SELECT geohash FROM keys WHERE key_class = 'cold'")
def _(spark, d):
    return H.cold_keys(*split(spark, d))


@query("cold_rows", "SELECT a.Index, CASE WHEN k.key_class = 'cold' THEN 1 ELSE 0 END AS is_cold FROM allrows a JOIN keys k ON k.geohash = a.geohash")
def _(spark, d):
    train, test = split(spark, d)
    cold = H.cold_keys(train, test).withColumn("_cold", F.lit(1))
    rows = H.stack_rows(train, test).join(cold, "geohash", "left")
    return rows.selectExpr("Index", "coalesce(_cold, 0) as is_cold")


@query("unseen_for_cluster", "SELECT DISTINCT geohash FROM test WHERE geohash NOT IN (SELECT geohash FROM train)")
def _(spark, d):
    train, test = split(spark, d)
    return clusters.unseen_keys(test, train)


def zone_rule(spark: SparkSession, d: str) -> DataFrame:
    """A fixed zone per key: its five-character prefix."""
    train, test = split(spark, d)
    return train.select("geohash").unionByName(test.select("geohash")).distinct().selectExpr(
        "geohash", "substring(geohash, 1, 5) as geohash_cluster")


def with_zones(spark: SparkSession, d: str) -> DataFrame:
    features = ["same_slot_genuine", "same_slot_proxy"]
    rows = attached(spark, d, *features).selectExpr(
        "*", "case when not is_test and day = 48 then same_slot_proxy else same_slot_genuine end as demand_d48_same_slot")
    return H.cluster_features(rows, profile(spark, d), zone_rule(spark, d))


ZONE_MEAN = """FROM feat f JOIN cluster c ON c.geohash = f.geohash CROSS JOIN gm
    LEFT JOIN cls ON cls.geohash_cluster = c.geohash_cluster AND cls.s = f.s LEFT JOIN sm ON sm.s = f.s"""


@query("cluster_slot_join", f"SELECT f.Index, c.geohash_cluster, {r('coalesce(cls.m, sm.sm, gm.gm)', 'cluster_slot_mean')} {ZONE_MEAN}")
def _(spark, d):
    return out(with_zones(spark, d), "Index", "geohash_cluster", "~demand_d48_cluster_slot_mean as cluster_slot_mean")


@query("diff_from_cluster", f"SELECT f.Index, {r(f'f.demand_d48_same_slot / (coalesce(cls.m, sm.sm, gm.gm) + {O.EPS}) - 1', 'diff_from_cluster')} {ZONE_MEAN}")
def _(spark, d):
    return out(with_zones(spark, d), "Index", "~demand_d48_diff_from_cluster as diff_from_cluster")


@query("global_fallback", f"SELECT t.Index, {r('coalesce(gh.mean, gm.gm)', 'level')} FROM test t CROSS JOIN gm LEFT JOIN gh ON gh.geohash = t.geohash")
def _(spark, d):
    prof = profile(spark, d)
    rows = V.unlabelled(spark, d).join(P.grouped(prof, ["geohash"], level=P.MEAN), "geohash", "left")
    return out(rows.withColumn("overall", P.global_mean(prof).scalar()), "Index", "~coalesce(level, overall) as level")


@query("impute_temperature", f"SELECT Index, {r('Temperature')} FROM temp")
def _(spark, d):
    train, test = stored(spark, d)
    return out(impute.impute_median(train, H.stack_rows(train, test), "Temperature"), "Index", "~Temperature")


@query("impute_mode", f"""
    SELECT b.Index, coalesce(b.RoadType, r.v, (SELECT v FROM {O.mode('RoadType', [])})) AS RoadType,
           coalesce(b.Weather, w1.v, w2.v, (SELECT v FROM {O.mode('Weather', [])})) AS Weather,
           coalesce(b.Weather, w3.v, w2.v, (SELECT v FROM {O.mode('Weather', [])})) AS hourly
    FROM (SELECT Index, geohash, day, hour, RoadType, Weather FROM train UNION ALL SELECT Index, geohash, day, hour, RoadType, Weather FROM test) b
    LEFT JOIN {O.mode('RoadType', ['geohash'])} r ON r.geohash = b.geohash
    LEFT JOIN {O.mode('Weather', ['geohash', 'day'])} w1 ON w1.geohash = b.geohash AND w1.day = b.day
    LEFT JOIN {O.mode('Weather', ['geohash'])} w2 ON w2.geohash = b.geohash
    LEFT JOIN {O.mode('Weather', ['geohash', 'hour'])} w3 ON w3.geohash = b.geohash AND w3.hour = b.hour""")
def _(spark, d):
    train, test = stored(spark, d)
    rows = H.stack_rows(train, test).withColumn("hourly", F.col("Weather"))
    train = train.withColumn("hourly", F.col("Weather"))
    rows = impute.impute_mode(train, rows, "RoadType", [["geohash"], []])
    rows = impute.impute_mode(train, rows, "Weather", [["geohash", "day"], ["geohash"], []])
    rows = impute.impute_mode(train, rows, "hourly", [["geohash", "hour"], ["geohash"], []])
    return rows.select("Index", "RoadType", "Weather", "hourly")


@query("stored_day_ratio", f"""
    SELECT a.geohash, {r('a.m', 'history_mean')}, {r('b.m', 'target_mean')}, {r(f'b.m / (a.m + {O.EPS})', 'ratio')}
    FROM (SELECT geohash, avg(demand) AS m FROM train WHERE day = 48 GROUP BY geohash) a
    JOIN (SELECT geohash, avg(demand) AS m FROM train WHERE day = 49 GROUP BY geohash) b ON b.geohash = a.geohash""")
def _(spark, d):
    path = scratch_path(spark, "grid")
    name = path.rpartition("/")[-1].replace("-", "_")
    grid = ST.store_grid(H.stack_rows(*split(spark, d)), name, path, 8)
    result = materialize(ST.day_ratio(grid))
    ST.drop_grid(spark, name)
    return out(result, "geohash", "~history_mean", "~target_mean", "~ratio")


@query("group_folds", "SELECT geohash, n, fold FROM gfold")
def _(spark, d):
    return folds.balanced_folds(V.labelled(spark, d), "geohash", 5)


@query("group_fold_te", f"""
    WITH gy AS (SELECT t.Index, substr(t.geohash, 1, 4) AS px, ln(t.demand) AS y, g.fold FROM train t JOIN gfold g ON g.geohash = t.geohash),
         gp AS (SELECT avg(y) AS prior FROM gy),
         gs AS (SELECT px, fold, sum(y) AS s, count(*) AS c FROM gy GROUP BY px, fold),
         gt AS (SELECT a.px, a.fold, sum(b.s) AS s, sum(b.c) AS c FROM gs a LEFT JOIN gs b ON b.px = a.px AND b.fold <> a.fold GROUP BY a.px, a.fold)
    SELECT gy.Index, gy.fold, {r('(coalesce(gt.s, 0) + 30 * gp.prior) / (coalesce(gt.c, 0) + 30)', 'te')}
    FROM gy CROSS JOIN gp JOIN gt ON gt.px = gy.px AND gt.fold = gy.fold""")
def _(spark, d):
    train = V.stored(spark, d)[0].selectExpr("Index", "geohash", "substring(geohash, 1, 4) as px", "ln(demand) as y_log")
    rows = folds.with_folds(train, folds.balanced_folds(train, "geohash", 5), "geohash")
    return out(encoding.foldsafe_te(rows, rows, ["px"], "y_log", 5, SP.te_smoothing), "Index", "fold", "~te")


# The second-level features: four first-level predictions, the fold-safe key encoding and the time of day.
STACKED = [*STANDINS, "geohash_te", "minute_of_day"]


def stacked_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(oof(spark, d))
    return encoding.foldsafe_te(rows, rows, ["geohash"], "y_log", 1, SP.te_smoothing, "geohash_te").where("fold = 0")


@query("ridge_stack", O.ridge("SELECT 1.0 AS alpha, * FROM stackrows", "alpha") + " SELECT alpha, "
       + rr(*[f"w_{f}" for f in STACKED], "intercept") + " FROM solved")
def _(spark, d):
    return out(stacking.fit(stacked_rows(spark, d), STACKED), "alpha", *[f"~w_{f}" for f in STACKED], "~intercept")


@query("ridge_stack_cv", O.ridge(
    "SELECT f.fold AS fold, a.alpha AS alpha, r.* EXCLUDE (fold) FROM stackrows r JOIN (SELECT DISTINCT fold FROM gfold) f ON f.fold <> r.fold"
    " CROSS JOIN (VALUES (0.1), (1.0), (10.0), (100.0)) a(alpha)", "fold, alpha") + f"""
    SELECT alpha, count(*) AS n, {r(O.r2('y', 'p'), 'r2')} FROM (
        SELECT s.alpha, {O._from_log('r.y_log')} AS y, {O._from_log('s.intercept + ' + ' + '.join(f's.w_{f} * r.{f}' for f in STACKED))} AS p
        FROM stackrows r JOIN solved s ON s.fold = r.fold) GROUP BY alpha""")
def _(spark, d):
    rows = materialize(stacked_rows(spark, d).drop("fold"))
    rows = folds.with_folds(rows, folds.balanced_folds(V.labelled(spark, d), "geohash", 5), "geohash")
    return out(stacking.cross_validate(rows, STACKED, "fold", [0.1, 1.0, 10.0, 100.0]), "alpha", "n", "~r2")


@query("key_reconcile", "SELECT (SELECT count(*) FROM test WHERE geohash NOT IN (SELECT geohash FROM keys WHERE key_class = 'warm')) AS missing, CAST(0 AS BIGINT) AS extra, (SELECT count(*) FROM test WHERE geohash IN (SELECT geohash FROM keys WHERE key_class = 'warm')) AS matched")
def _(spark, d):
    warm = history_rows(spark, d).select("geohash").distinct()
    ids = V.unlabelled(spark, d).select("Index", "geohash")
    return Q.reconcile(ids.select("Index"), ids.join(warm, "geohash", "left_semi").select("Index"), "Index")


@query("reattach_label", f"SELECT Index, day, demand, {r('y_log')}, fold FROM (SELECT o.*, t.day FROM oof o JOIN train t ON t.Index = o.Index)")
def _(spark, d):
    labels = V.labelled(spark, d).select("Index", "day", "demand")
    return out(oof(spark, d).select("Index", "y_log", "fold").join(labels, "Index"), "Index", "day", "demand", "~y_log", "fold")


@query("last_known", f"SELECT Index, {r('demand_d49_last_known', 'last_known')} FROM anchors")
def _(spark, d):
    return out(target_day.target_day_features(*split(spark, d)), "Index", "~demand_d49_last_known as last_known")


# --- aggregates -----------------------------------------------------------------------

@query("global_mean", f"SELECT {r('gm', 'global_mean')} FROM gm")
def _(spark, d):
    return out(P.global_mean(profile(spark, d)), "~global_mean")


@query("slot_profile", f"SELECT geohash, s AS minute_of_day, n, {r('total')}, {r('v', 'mean')} FROM prof")
def _(spark, d):
    return out(profile(spark, d), "geohash", "minute_of_day", "n", "~total", "~mean")


def entity_query(name: str, columns: dict[str, str]) -> None:
    @query(name, "SELECT geohash, " + ", ".join(r(theirs, ours) for ours, theirs in columns.items()) + " FROM gh")
    def _(spark, d):
        return out(P.entity_stats(profile(spark, d)), "geohash", *[f"~{c}" for c in columns])


entity_query("entity_mean", {"mean": "mean"})
entity_query("entity_std", {"std": "std"})
entity_query("entity_cv", {"cv": "cv"})
entity_query("entity_total", {"total": "total"})
entity_query("period_means", {c: c for c in ("night_mean", "peak_am_mean", "midday_mean", "peak_pm_mean")})


@query("slot_mean", f"SELECT s AS minute_of_day, {r('sm', 'slot_mean')} FROM sm")
def _(spark, d):
    return out(P.slot_mean(profile(spark, d)), "minute_of_day", "~slot_mean")


@query("slot_shape", f"SELECT sm.s AS minute_of_day, {r(f'sm.sm / (gm.gm + {O.EPS})', 'slot_shape')} FROM sm CROSS JOIN gm")
def _(spark, d):
    return out(P.slot_shape(profile(spark, d)), "minute_of_day", "~slot_shape")


@query("entity_hour_stats", f"SELECT geohash, hour, {r('hs', 'hour_sum')}, hc AS hour_cnt, {r('hm', 'hour_mean')} FROM ghh0")
def _(spark, d):
    return out(P.entity_hour_stats(profile(spark, d)), "geohash", "hour", "~hour_sum", "hour_cnt", "~hour_mean")


@query("prefix_mean", f"SELECT px AS prefix, {r('m', 'prefix_mean')} FROM px5 UNION ALL SELECT px, {r('m', 'prefix_mean')} FROM px4")
def _(spark, d):
    prof = profile(spark, d)
    return out(P.prefix_mean(prof, 5).unionByName(P.prefix_mean(prof, 4)), "prefix", "~prefix_mean")


@query("prefix_slot_mean", f"SELECT px AS prefix, s AS minute_of_day, {r('m', 'prefix_slot_mean')} FROM px5s UNION ALL SELECT px, s, {r('m', 'prefix_slot_mean')} FROM px4s")
def _(spark, d):
    prof = profile(spark, d)
    both = P.prefix_slot_mean(prof, 5).unionByName(P.prefix_slot_mean(prof, 4))
    return out(both, "prefix", "minute_of_day", "~prefix_slot_mean")


@query("entity_quantiles", f"SELECT geohash, {rr('p10', 'p90')} FROM gh")
def _(spark, d):
    return out(P.entity_quantiles(history_rows(spark, d)), "geohash", "~p10", "~p90")


@query("cluster_slot_mean", f"SELECT geohash_cluster, s AS minute_of_day, {r('m', 'cluster_slot_mean')} FROM cls")
def _(spark, d):
    return out(P.cluster_slot_mean(profile(spark, d), zone_rule(spark, d)), "geohash_cluster", "minute_of_day", "~cluster_slot_mean")


@query("median_levels", f"""
    SELECT 'key_hour' AS level, geohash, hour, {r('median(Temperature)', 'median')} FROM train WHERE Temperature IS NOT NULL GROUP BY geohash, hour
    UNION ALL SELECT 'key', geohash, NULL, {r('median(Temperature)', 'median')} FROM train WHERE Temperature IS NOT NULL GROUP BY geohash
    UNION ALL SELECT 'global', NULL, NULL, {r('median(Temperature)', 'median')} FROM train""")
def _(spark, d):
    levels = impute.median_levels(V.labelled(spark, d), "Temperature")
    rows = [
        df.selectExpr(f"'{name}' as level", *[c if c in df.columns else f"cast(null as {t}) as {c}"
                                              for c, t in (("geohash", "string"), ("hour", "int"))], "median")
        for name, df in levels.items()
    ]
    return out(rows[0].unionByName(rows[1]).unionByName(rows[2]), "level", "geohash", "hour", "~median")


@query("smoothed_te", f"SELECT l_returnflag, l_linestatus, {r('(sum(l_quantity) + 30 * any_value(p.prior)) / (count(*) + 30)', 'te')} FROM lineitem CROSS JOIN (SELECT avg(l_quantity) AS prior FROM lineitem) p GROUP BY ALL")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    prior = rows.agg(F.avg("l_quantity")).scalar()
    by = ["l_returnflag", "l_linestatus"]
    return out(encoding.smoothed_te(rows, by, "l_quantity", prior, SP.te_smoothing), *by, "~te")


@query("foldsafe_te", f"""
    SELECT k.Index, {r('k.te', 'geohash_te')}, {r('p.te', 'geohash_prefix_te')}, {r('h.te', 'geohash_hour_te')}
    FROM te_k k JOIN te_px p ON p.Index = k.Index JOIN te_kh h ON h.Index = k.Index""")
def _(spark, d):
    train, test = split(spark, d)
    extra = ["*", "substring(geohash, 1, 4) as px"]
    train = train.selectExpr(*extra, f"{X.temporal_fold('day')} as fold", "ln(demand) as y_log")
    rows = H.stack_rows(train, test.selectExpr(*extra, "cast(null as int) as fold"))
    for by, name in ((["geohash"], "geohash_te"), (["px"], "geohash_prefix_te"), (["geohash", "hour"], "geohash_hour_te")):
        rows = encoding.foldsafe_te(train, rows, by, "y_log", 1, SP.te_smoothing, name)
    return out(rows, "Index", "~geohash_te", "~geohash_prefix_te", "~geohash_hour_te")


@query("foldsafe_te_5", f"""
    WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_orderkey % 5 AS fold FROM lineitem),
         p AS (SELECT avg(l_quantity) AS prior FROM l),
         a AS (SELECT l_suppkey, sum(l_quantity) AS s, count(*) AS c FROM l GROUP BY l_suppkey),
         f AS (SELECT l_suppkey, fold, sum(l_quantity) AS s, count(*) AS c FROM l GROUP BY ALL)
    SELECT l.l_orderkey, l.l_linenumber, {r('(a.s - f.s + 30 * p.prior) / (a.c - f.c + 30)', 'te')}
    FROM l CROSS JOIN p JOIN a ON a.l_suppkey = l.l_suppkey JOIN f ON f.l_suppkey = l.l_suppkey AND f.fold = l.fold""")
def _(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "cast(l_orderkey % 5 as int) as fold")
    return out(encoding.foldsafe_te(rows, rows, ["l_suppkey"], "l_quantity", 5), "l_orderkey", "l_linenumber", "~te")


@query("loo_hour_mean", f"SELECT Index, {r('demand_d48_gh_hour_mean', 'loo_hour_mean')} FROM feat WHERE day = 48 AND NOT is_test")
def _(spark, d):
    rows = attached(spark, d, "hour_sum", "hour_cnt", "hour_fallback").where("not is_test and day = 48")
    return out(rows, "Index", f"~{encoding.leave_one_out('hour_sum', 'hour_cnt', 'demand', 'hour_fallback')} as loo_hour_mean")


@query("loo_target_mean", f"SELECT Index, {r('demand_d49_morning_mean', 'loo_mean')} FROM anchors WHERE day = 49 AND NOT is_test")
def _(spark, d):
    rows = target_day.target_day_features(*split(spark, d)).where("not is_test and day = 49")
    return out(rows, "Index", "~demand_d49_morning_mean as loo_mean")


@query("target_day_stats", f"SELECT geohash, {r('ds', 'day_sum')}, dc AS day_cnt, {r('dm', 'day_mean')}, {r('dl', 'day_last')} FROM td")
def _(spark, d):
    stats = encoding.target_day_stats(P.on_day(V.labelled(spark, d), SP.target_day))
    return out(stats, "geohash", "~day_sum", "day_cnt", "~day_mean", "~day_last")


@query("dataset_profile", f"""
    SELECT count(*) AS n_rows, count(DISTINCT geohash) AS n_keys, '48,49' AS days, count(demand) AS n_values, {r('avg(demand)', 'mean')},
           {r('stddev_samp(demand)', 'std')}, {r('min(demand)', 'min')}, {r('quantile_cont(demand, 0.25)', 'q25')},
           {r('quantile_cont(demand, 0.5)', 'q50')}, {r('quantile_cont(demand, 0.75)', 'q75')}, {r('max(demand)', 'max')} FROM train""")
def _(spark, d):
    return out(E.describe(V.labelled(spark, d), "demand", "geohash", "day"), "n_rows", "n_keys", "days", "n_values",
               "~mean", "~std", "~min", "~q25", "~q50", "~q75", "~max")


# --- windows --------------------------------------------------------------------------

@query("velocity", f"SELECT geohash, s AS minute_of_day, {r('velocity')} FROM dyn")
def _(spark, d):
    return out(P.dynamics(profile(spark, d)), "geohash", "minute_of_day", "~velocity")


@query("acceleration", f"SELECT geohash, s AS minute_of_day, {r('acceleration')} FROM dyn")
def _(spark, d):
    return out(P.dynamics(profile(spark, d)), "geohash", "minute_of_day", "~acceleration")


@query("rank_in_day", f"SELECT geohash, s AS minute_of_day, {r('rank_in_day')} FROM dyn")
def _(spark, d):
    return out(P.rank_in_day(profile(spark, d)), "geohash", "minute_of_day", "~rank_in_day")


@query("hour_rank", f"SELECT geohash, hour, {r('hr', 'hour_rank')} FROM ghh")
def _(spark, d):
    return out(P.hour_rank(P.entity_hour_stats(profile(spark, d))), "geohash", "hour", "~hour_rank")


@query("group_size", "SELECT Index, geohash, count(*) OVER (PARTITION BY geohash) AS group_size FROM t")
def _(spark, d):
    return P.group_size(P.on_day(V.labelled(spark, d), SP.target_day), "geohash").select("Index", "geohash", "group_size")


# --- evaluation -------------------------------------------------------------------------

@query("r2_original_scale", f"SELECT count(*) AS n, {r(O.r2('y', 'p'), 'r2')} FROM val")
def _(spark, d):
    return out(E.r2_original_scale(validation(spark, d)), "n", "~r2")


@query("score", f"SELECT {r('greatest(0, 100 * (' + O.r2('y', 'p') + '))', 'score')} FROM val")
def _(spark, d):
    return out(E.r2_original_scale(validation(spark, d)), f"~{E.competition_score('r2')} as score")


@query("model_r2", f"""
    SELECT model, count(*) AS n, {r(O.r2('y', 'p'), 'r2')}, {r('avg(p)', 'pred_mean')}
    FROM (SELECT model, {O._from_log('y_log')} AS y, {O._from_log('p_log')} AS p FROM models) GROUP BY model""")
def _(spark, d):
    rows = oof(spark, d).where("fold = 0").withColumn("oof_none", F.lit(None).cast("double"))
    return out(E.model_r2(rows, [*STANDINS, "oof_none"]), "model", "n", "~r2", "~pred_mean")


SKEW = "(avg(power(res, 3)) - 3 * avg(res) * avg(res * res) + 2 * power(avg(res), 3)) / power(stddev_pop(res), 3)"
RESIDUAL = {"mean": "avg(res)", "median": "quantile_cont(res, 0.5)", "std": "stddev_pop(res)", "skew": SKEW,
            **{f"p{q}": f"quantile_cont(res, {q / 100})" for q in (5, 25, 75, 95)}}


@query("residual_stats", "SELECT count(*) AS n, " + ", ".join(r(e, c) for c, e in RESIDUAL.items()) + " FROM valb")
def _(spark, d):
    return out(E.residual_stats(validation(spark, d)), "n", *[f"~{c}" for c in RESIDUAL])


@query("bucket_metrics", f"SELECT bucket, label, n, {rr('r2', 'mae', 'acc')} FROM bmetrics")
def _(spark, d):
    return out(E.bucket_metrics(validation(spark, d)), "bucket", "label", "n", "~r2", "~mae", "~acc")


@query("confusion_matrix", "SELECT * FROM cm")
def _(spark, d):
    return E.confusion_matrix(validation(spark, d))


@query("macro_accuracy", f"SELECT {r('avg(acc)', 'macro_acc')}, count(acc) AS n_buckets FROM diag")
def _(spark, d):
    return out(E.macro_accuracy(E.confusion_matrix(validation(spark, d))), "~macro_acc", "n_buckets")


def dist_sql(v: str, source: str) -> str:
    cols = {**{f"p{q}": f"quantile_cont({v}, {q / 100})" for q in (10, 25, 50, 75, 90, 99)},
            "mean": f"avg({v})", "std": f"stddev_pop({v})",
            **{f"frac{i}": f"avg(CASE WHEN {O.bucket(v)} = {i} THEN 1.0 ELSE 0.0 END)" for i in range(4)}}
    return "SELECT count(*) AS n, " + ", ".join(r(e, c) for c, e in cols.items()) + f" FROM {source}"


@query("value_distribution", dist_sql("demand", "train"))
def _(spark, d):
    dist = E.value_distribution(V.labelled(spark, d), "demand")
    return out(dist, "n", *[f"~{c}" for c in dist.columns if c != "n"])


@query("value_distribution_lineitem", dist_sql("(l_extendedprice / 1e6)", "lineitem"))
def _(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_extendedprice / 1e6D as v")
    dist = E.value_distribution(rows, "v")
    return out(dist, "n", *[f"~{c}" for c in dist.columns if c != "n"])


@query("spatial_breakdown", f"SELECT {r('avg(mae)', 'mae_mean')}, {r('stddev_pop(mae)', 'mae_std')}, {r('min(mae)', 'mae_min')}, {r('max(mae)', 'mae_max')}, count(*) AS n_keys FROM err")
def _(spark, d):
    return out(E.spatial_breakdown(validation(spark, d)), "~mae_mean", "~mae_std", "~mae_min", "~mae_max", "n_keys")


@query("worst_entities", f"SELECT geohash, {r('mae')} FROM (SELECT * FROM err ORDER BY mae DESC, geohash LIMIT 5)")
def _(spark, d):
    return out(E.worst_entities(validation(spark, d)), "geohash", "~mae")


@query("temporal_breakdown", f"SELECT hour, n, {r('r2')} FROM byhour")
def _(spark, d):
    return out(E.temporal_breakdown(validation(spark, d)), "hour", "n", "~r2")


@query("temporal_summary", f"SELECT min(r2) AS r2_min, max(r2) AS r2_max, arg_min(hour, r2 * 1000 + hour * 1e-9) AS worst_hour FROM (SELECT hour, {r('r2', digits=4)} FROM byhour WHERE r2 IS NOT NULL)")
def _(spark, d):
    return E.temporal_summary(E.temporal_breakdown(validation(spark, d)))


@query("oof_correlation", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM oof WHERE fold = 0"
    for i, a in enumerate([*STANDINS, "y_log"]) for b in [*STANDINS, "y_log"][i + 1:]))
def _(spark, d):
    return out(E.correlations(oof(spark, d).where("fold = 0"), [*STANDINS, "y_log"]), "a", "b", "~r")


@query("prediction_summary", f"""
    SELECT count(*) AS n, {r('min(p)', 'min')}, {r('max(p)', 'max')}, {r('avg(p)', 'mean')}, {r('median(p)', 'median')}, {r('stddev_pop(p)', 'std')},
           {r('100 * avg(CASE WHEN p <= 1e-6 + 1e-12 OR p >= 1 - 1e-12 THEN 1.0 ELSE 0.0 END)', 'pct_clipped')}
    FROM (SELECT {O._from_log('2 * ln(demand) + 3')} AS p FROM train)""")
def _(spark, d):
    rows = V.labelled(spark, d).selectExpr(f"{X.from_log('2 * ln(demand) + 3')} as p")
    return out(E.prediction_summary(rows, "p"), "n", "~min", "~max", "~mean", "~median", "~std", "~pct_clipped")


@query("fold_summary", f"SELECT fold, count(*) AS n, {r('avg(demand)', 'mean')}, {r('median(demand)', 'median')} FROM oof GROUP BY fold")
def _(spark, d):
    rows = V.labelled(spark, d).selectExpr("demand", f"{X.temporal_fold('day')} as fold")
    return out(E.fold_summary(rows, "demand"), "fold", "n", "~mean", "~median")


@query("best_run", f"""
    SELECT {r('max(lb)', 'best_lb')}, {r('max(blend_calib)', 'best_oof')}, max(ts) AS latest_ts,
           (SELECT note FROM runs ORDER BY ts DESC, blend_calib DESC LIMIT 1) AS latest_note FROM runs""")
def _(spark, d):
    return out(reports.best_run(run_log(spark, d)), "~best_lb", "~best_oof", "latest_ts", "latest_note")


# --- sort, set operations ----------------------------------------------------------------

@query("ordered_output", "SELECT Index, geohash, demand FROM train ORDER BY Index")
def _(spark, d):
    return V.labelled(spark, d).select("Index", "geohash", "demand").orderBy("Index")


@query("preview", f"SELECT t.Index, {r(f'coalesce(sm.sm / (gm.gm + {O.EPS}), 1.0) * coalesce(gh.mean, gm.gm)', 'demand')} FROM test t CROSS JOIN gm LEFT JOIN sm ON sm.s = t.s LEFT JOIN gh ON gh.geohash = t.geohash ORDER BY t.Index LIMIT 10")
def _(spark, d):
    return out(naive_forecast(spark, d).orderBy("Index").limit(10), "Index", "~demand")


@query("union_parts", "SELECT Index, day, is_test FROM allrows")
def _(spark, d):
    return H.stack_rows(*split(spark, d)).select("Index", "day", "is_test")


@query("distinct_entities", "SELECT geohash, arg_min(NumberofLanes, Index) AS NumberofLanes FROM base WHERE split IN ('train', 'test') GROUP BY geohash")
def _(spark, d):
    train, test = split(spark, d)
    return P.grouped(H.stack_rows(train, test), ["geohash"], NumberofLanes="min_by(NumberofLanes, Index)")


# --- zones, blending ------------------------------------------------------------------------

@query("spatial_clusters")
def _(spark, d):
    return clusters.spatial_clusters(*split(spark, d))


@query("assign_centroid", """
    SELECT geohash, cluster FROM (
        SELECT l.geohash, c.cluster, row_number() OVER (PARTITION BY l.geohash ORDER BY
               (l.lat - c.lat) * (l.lat - c.lat) + (l.lon - c.lon) * (l.lon - c.lon), c.cluster) AS rn
        FROM latlon l CROSS JOIN centres c) WHERE rn = 1""")
def _(spark, d):
    rows = V.observations(spark, d)
    points = geo.decode(rows)
    lanes = rows.select("geohash", "NumberofLanes").distinct()
    # one centre per number of lanes
    means = P.grouped(points.join(lanes, "geohash"), ["NumberofLanes"], lat="avg(lat)", lon="avg(lon)")
    centres = means.selectExpr("row_number() over (order by NumberofLanes) - 1 as cluster", "lat", "lon")
    return clusters.assign_centroid_table(points, centres).select("geohash", "cluster")


@query("blend_weights", "SELECT w_oof_a, w_oof_b, w_oof_forest, w_oof_c, " + rr("r2", "score") + " FROM best")
def _(spark, d):
    scores = B.simplex_scores(materialize(oof(spark, d).where("fold = 0")), STANDINS)
    best = B.best_weights(scores, STANDINS)
    return out(best, *[f"w_{m}" for m in STANDINS], "~r2", "~score")


@query("blend_starts", "SELECT w_oof_a, w_oof_b, w_oof_forest, w_oof_c, " + rr("r2", "score") + """ FROM (
    SELECT c.i / 20.0 AS w_oof_a, c.j / 20.0 AS w_oof_b, c.l / 20.0 AS w_oof_forest, c.m / 20.0 AS w_oof_c, c.r2, c.r2 - 0.01 * c.sq AS score
    FROM cand c WHERE NOT EXISTS (SELECT 1 FROM cand n WHERE n.r2 - 0.01 * n.sq > c.r2 - 0.01 * c.sq
      AND abs(n.i - c.i) + abs(n.j - c.j) + abs(n.l - c.l) + abs(n.m - c.m) = 2)
    ORDER BY score DESC, c.i, c.j, c.l, c.m LIMIT 5)""")
def _(spark, d):
    scores = B.simplex_scores(materialize(oof(spark, d).where("fold = 0")), STANDINS)
    return out(B.grid_optima(scores, STANDINS), *[f"w_{m}" for m in STANDINS], "~r2", "~score")


@query("blend_apply", f"""
    SELECT o.Index, {r(O._from_log('b.w_oof_a * o.oof_a + b.w_oof_b * o.oof_b + b.w_oof_forest * o.oof_forest + b.w_oof_c * o.oof_c'), 'blend')}
    FROM oof o CROSS JOIN best b WHERE o.fold = 0""")
def _(spark, d):
    rows = materialize(oof(spark, d).where("fold = 0"))
    best = B.best_weights(B.simplex_scores(rows, STANDINS), STANDINS)
    return out(B.apply_weights(rows, STANDINS, best), "Index", "~blend")


@query("calibration_grid", f"SELECT {r('log_shift')}, {r('r2')} FROM shifts")
def _(spark, d):
    return out(B.shift_scores(validation(spark, d)), "~log_shift", "~r2")


@query("calibration", f"SELECT {r('log_shift')}, {r('r2')}, {r('0.5 * log_shift', 'applied_shift')} FROM shifts ORDER BY shifts.r2 DESC, shifts.log_shift LIMIT 1")
def _(spark, d):
    best = B.best_shift(B.shift_scores(materialize(validation(spark, d))), shrink=0.5)
    return out(best, "~log_shift", "~r2", "~applied_shift")


@query("reblend", f"""
    SELECT Index, {r('0.1 * oof_a + 0.2 * oof_b + 0.6 * oof_forest + 0.1 * oof_c', 'with_weights')},
           {r('1.1 * (0.3 * oof_a + 0.7 * oof_b) - 0.2', 'two_models')},
           {r('0.1 * oof_a + 0.2 * oof_b + 0.6 * oof_forest', 'without_c')}, {r('0.3 * oof_a + 0.7 * oof_b', 'without_forest')}
    FROM oof WHERE fold = 0""")
def _(spark, d):
    rows = oof(spark, d).where("fold = 0")
    both = B.reblend(rows, WEIGHTS, ("oof_a", "oof_b", 0.3)).withColumnRenamed("p_log", "with_weights")
    both = B.reblend(both, None, ("oof_a", "oof_b", 0.3), calibration=(1.1, -0.2)).withColumnRenamed("p_log", "two_models")
    both = both.withColumns({"kept_c": F.col("oof_c"), "oof_c": F.lit(None).cast("double")})
    both = B.reblend(both, WEIGHTS, ("oof_a", "oof_b", 0.3)).withColumnRenamed("p_log", "without_c")
    both = both.withColumn("oof_forest", F.lit(None).cast("double"))
    both = B.reblend(both, WEIGHTS, ("oof_a", "oof_b", 0.3))
    return out(both, "Index", "~with_weights", "~two_models", "~without_c", "~p_log as without_forest")


# --- learned models (rows-only check) ---------------------------------------------------------

def trained(spark: SparkSession, d: str, refit: bool = False) -> M.Trained:
    train, test = stored(spark, d)
    zones = clusters.spatial_clusters(train, test)
    return M.train_ensemble(FM.build_features(train, test, clusters=zones), refit=refit)


@query("train_ensemble")
def _(spark, d):
    return M.fold_metrics(trained(spark, d))


@query("oof_predictions")
def _(spark, d):
    return trained(spark, d).oof


@query("final_predictions")
def _(spark, d):
    result = trained(spark, d, refit=True)
    best = B.best_weights(B.simplex_scores(materialize(result.oof.where("fold = 0")), M.MODELS), M.MODELS)
    return B.apply_weights(result.test, M.MODELS, best).selectExpr("Index", "blend as demand")


@query("top_features")
def _(spark, d):
    final = trained(spark, d, refit=True).final_models
    return M.top_features(M.feature_importance(final.models["oof_a"], final.inputs["oof_a"], spark))


# What SQL can say about the learners' results: which rows they cover and in which bounds they lie.
_FACTS = {
    "rows_fit": "(SELECT count(*) FROM oof WHERE fold = -1)", "rows_validated": "(SELECT count(*) FROM oof WHERE fold = 0)",
    **{f"{m}_predicted": "(SELECT count(*) FROM oof WHERE fold = 0)" for m in M.MODELS},
    "predicted_in_fit": "0", "ids": "(SELECT count(DISTINCT Index) FROM oof)",
    "test_rows": "(SELECT count(*) FROM test)", "test_ids": "(SELECT count(DISTINCT Index) FROM test)", "test_out_of_range": "0",
    "weight_sum": "1", "negative_weights": "0", "importance_sum": "1", "importance_names": str(len(S.NUMERIC_FEATURES) + 3),
    "negative_importances": "0",
}


@query("ensemble_facts", " UNION ALL ".join(f"SELECT '{k}' AS fact, CAST({v} AS DOUBLE) AS value FROM gm" for k, v in _FACTS.items()))
def _(spark, d):
    result = trained(spark, d, refit=True)
    rows = materialize(result.oof)
    best = B.best_weights(B.simplex_scores(rows.where("fold = 0"), M.MODELS), M.MODELS)
    final = materialize(B.apply_weights(result.test, M.MODELS, best))
    models = result.final_models
    importance = M.feature_importance(models.models["oof_a"], models.inputs["oof_a"], spark)
    weights = [f"w_{m}" for m in M.MODELS]
    facts = {
        "rows_fit": (rows, "count_if(fold = -1)"), "rows_validated": (rows, "count_if(fold = 0)"),
        **{f"{m}_predicted": (rows, f"count_if(fold = 0 and {m} is not null and not isnan({m}))") for m in M.MODELS},
        "predicted_in_fit": (rows, f"count_if(fold = -1 and coalesce({', '.join(M.MODELS)}) is not null)"),
        "ids": (rows, "count(distinct Index)"), "test_rows": (final, "count(*)"), "test_ids": (final, "count(distinct Index)"),
        "test_out_of_range": (final, "count_if(blend is null or not blend > 0 or blend > 1)"),
        "weight_sum": (best, f"round(sum({' + '.join(weights)}), 9)"), "negative_weights": (best, f"count_if(least({', '.join(weights)}) < 0)"),
        "importance_sum": (importance, "round(sum(score), 9)"), "importance_names": (importance, "count(distinct name)"),
        "negative_importances": (importance, "count_if(score < 0)"),
    }
    parts = [df.selectExpr(f"'{name}' as fact", f"cast({e} as double) as value") for name, (df, e) in facts.items()]
    return reduce(DataFrame.unionAll, parts)


def binned_matrix(spark: SparkSession, d: str) -> DataFrame:
    """The labelled rows' numeric features as bin numbers; what searches and single fits read."""
    built = FM.build_features(*stored(spark, d)).where("not is_test")
    return search.binned(built, S.NUMERIC_FEATURES, ["Index", "fold", "y_log"])


def fact_rows(facts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    parts = [df.selectExpr(f"'{name}' as fact", f"cast({e} as double) as value") for name, (df, e) in facts.items()]
    return reduce(DataFrame.unionAll, parts)


def loss_gap(matrix: DataFrame, fit: boosting.Boosting, rounds: int) -> tuple[DataFrame, str]:
    """How far the reported loss is from the loss of the model's own predictions."""
    scored = fit.model(rounds).transform(matrix.where("fold = 0"))
    return scored, f"round(abs(avg((y_log - prediction) * (y_log - prediction)) - {fit.losses[rounds - 1]!r}D), 9)"


TRAIN_COUNTS = """SELECT 'rows_fit' AS fact, count(*) FILTER (day = 48) * 1.0 AS value FROM train
    UNION ALL SELECT 'rows_validated', count(*) FILTER (day = 49) * 1.0 FROM train"""

# Trials by rung: a third of those before goes on, one at least.
SEARCH_TRIALS, SEARCH_RUNGS = 6, (2, 5)


@query("search_facts", f"""
    {TRAIN_COUNTS} UNION ALL SELECT 'trials_' || rung, floor({SEARCH_TRIALS} / pow(3, rung)) FROM range({len(SEARCH_RUNGS)}) r(rung)
    UNION ALL SELECT fact, 0.0 FROM (VALUES ('better_trial_stopped'), ('best_not_the_best'), ('loss_gap')) f(fact)""")
def _(spark, d):
    matrix = binned_matrix(spark, d)
    found = search.successive_halving(matrix, search.random_trials(SEARCH_TRIALS), SEARCH_RUNGS)
    log = found.table(spark)
    worst = P.grouped(log.where("goes_on"), ["rung"], worst="max(loss)")
    stopped = log.where("not goes_on").join(worst, "rung")
    last = log.where(f"rung = {len(SEARCH_RUNGS) - 1}")
    best = found.fits[found.best]
    counts = {f"trials_{r}": (log, f"count_if(rung = {r})") for r in range(len(SEARCH_RUNGS))}
    return fact_rows({
        "rows_fit": (matrix, "count_if(fold = -1)"), "rows_validated": (matrix, "count_if(fold = 0)"), **counts,
        "better_trial_stopped": (stopped, "count_if(loss < worst)"),
        "best_not_the_best": (last, f"if(min_by(trial, struct(loss, trial)) = {found.best}, 0, 1)"),
        "loss_gap": loss_gap(matrix, best, best.losses.index(min(best.losses)) + 1)})


@query("boosting_facts", f"""
    {TRAIN_COUNTS} UNION ALL SELECT fact, 0.0 FROM (VALUES ('smaller_loss_seen'), ('rounds_beyond_patience'), ('loss_gap')) f(fact)""")
def _(spark, d):
    matrix, patience, chunk = binned_matrix(spark, d), 4, 3
    fit = boosting.Boosting(matrix, boosting.TreeParams(depth=4, step=0.5, row_share=0.8, feature_share=0.7, min_leaf=20))
    kept = boosting.boost(fit, 40, patience, chunk)
    losses = spark.createDataFrame(list(enumerate(fit.losses, 1)), "round int, loss double")
    until = f"round < {kept + patience} and loss < {fit.losses[kept - 1]!r}D"
    return fact_rows({
        "rows_fit": (matrix, "count_if(fold = -1)"), "rows_validated": (matrix, "count_if(fold = 0)"),
        "smaller_loss_seen": (losses, f"count_if({until})"),
        "rounds_beyond_patience": (losses, f"greatest(0, count(*) - {kept + patience + chunk - 1})"),
        "loss_gap": loss_gap(matrix, fit, kept)})


@query("zone_facts", f"""
    SELECT 'keys' AS fact, CAST(count(DISTINCT geohash) AS DOUBLE) AS value FROM base WHERE split IN ('train', 'test')
    UNION ALL SELECT 'keys_twice', 0.0 FROM gm UNION ALL SELECT 'not_at_nearest_centre', 0.0 FROM gm
    UNION ALL SELECT 'zones', least({SP.n_clusters}, count(DISTINCT geohash)) * 1.0 FROM train""")
def _(spark, d):
    train, test = split(spark, d)
    every = clusters.known_keys(train, test)
    fitted = clusters.fit_zones(every.where("seen"), SP.n_clusters)  # ten restarts
    centres = fitted.centres
    zones = materialize(clusters.assign_centroid(every, centres))
    table = spark.createDataFrame([(i, *c) for i, c in enumerate(centres)], "cluster int, lat double, lon double")
    nearest = clusters.assign_centroid_table(zones.withColumnRenamed("cluster", "given"), table)
    counts = P.grouped(zones, ["geohash"], n="count(*)")
    facts = {"keys": (counts, "count(*)"), "keys_twice": (counts, "count_if(n > 1)"),
             "not_at_nearest_centre": (nearest, "count_if(given <> cluster)"), "zones": (table, "count(*)")}
    parts = [df.selectExpr(f"'{name}' as fact", f"cast({e} as double) as value") for name, (df, e) in facts.items()]
    return reduce(DataFrame.unionAll, parts)


# --- composites ------------------------------------------------------------------------------

TABLES = ["total", "mean", "std", "cv", "log_mean", "p10", "p90", "night_mean", "peak_am_mean", "midday_mean", "peak_pm_mean"]


@query("history_tables", f"SELECT geohash, n, {rr(*TABLES)} FROM gh")
def _(spark, d):
    history = history_rows(spark, d)
    stats = P.entity_stats(P.slot_profile(history))
    return out(stats.join(P.entity_quantiles(history), "geohash", "left"), "geohash", "n", *[f"~{c}" for c in TABLES])


HISTORY = [*H.HISTORY_COLUMNS, "demand_d48_same_slot", "demand_d48_gh_hour_mean", "log_demand_d48_same_slot",
           "demand_d48_relative_slot", "demand_d48_zscore"]


@query("history_features", f"SELECT Index, {rr(*HISTORY)} FROM feat2 WHERE day = 48 AND NOT is_test")
def _(spark, d):
    rows = H.history_features(*stored(spark, d)).where("not is_test and day = 48")
    return out(rows, "Index", *[f"~{c}" for c in HISTORY])


@query("history_features_all", f"SELECT Index, is_test, {rr(*HISTORY)} FROM feat2")
def _(spark, d):
    return out(H.history_features(*stored(spark, d)), "Index", "is_test", *[f"~{c}" for c in HISTORY])


def row_query(name: str, column: str, cells: list[str]) -> None:
    """One row-level column built from the few cell features it needs."""

    @query(name, f"SELECT Index, {r(column)} FROM feat2")
    def _(spark, d):
        rows = attached(spark, d, *cells, "same_slot_genuine", "same_slot_proxy", "hour_fallback", "hour_sum",
                        "hour_cnt", "hour_mean")
        return out(H.row_features(rows), "Index", f"~{column}")


LEVEL = ["demand_d48_geohash_mean", "demand_d48_geohash_std"]
row_query("same_slot_log", "log_demand_d48_same_slot", LEVEL)
row_query("relative_slot", "demand_d48_relative_slot", LEVEL)
row_query("same_slot_zscore", "demand_d48_zscore", LEVEL)


@query("day_over_day_ratio", f"""
    SELECT a.Index, {r(f'a.demand_d49_morning_mean / (coalesce(gh.mean, sm.sm, gm.gm) + {O.EPS})', 'ratio')}
    FROM anchors a JOIN allrows x ON x.Index = a.Index CROSS JOIN gm LEFT JOIN gh ON gh.geohash = a.geohash LEFT JOIN sm ON sm.s = x.s""")
def _(spark, d):
    train, test = stored(spark, d)
    anchors = target_day.target_day_features(train, test).select("Index", "demand_d49_morning_mean")
    rows = H.attach_cell_features(train, test, ["demand_d48_geohash_mean"]).join(anchors, "Index")
    return out(rows, "Index", f"~demand_d49_morning_mean / (demand_d48_geohash_mean + {SP.eps}D) as ratio")


@query("target_day_features", f"SELECT Index, {rr('demand_d49_morning_mean', 'demand_d49_last_known')} FROM anchors")
def _(spark, d):
    return out(target_day.target_day_features(*split(spark, d)), "Index", "~demand_d49_morning_mean", "~demand_d49_last_known")


WHOLE = {"minute_of_day", "hour", "NumberofLanes", "large_vehicles", "landmarks", "Temperature_missing",
         "Weather_missing", "RoadType_missing"}
MATRIX_SQL = {
    "minute_of_day": "f.s", "hour": "f.hour",
    **{f"mod_{fn}{'' if h == 1 else h}": f"{fn}(2 * pi() * {h} * f.s / 1440)" for h in (1, 2, 3) for fn in ("sin", "cos")},
    "lat": "l.lat", "lon": "l.lon", "NumberofLanes": "a.NumberofLanes",
    "large_vehicles": "CASE WHEN a.LargeVehicles = 'Allowed' THEN 1 ELSE 0 END",
    "landmarks": "CASE WHEN a.Landmarks = 'Yes' THEN 1 ELSE 0 END", "Temperature": "temp.Temperature",
    **{f"{c}_missing": f"CASE WHEN a.{c} IS NULL THEN 1 ELSE 0 END" for c in ("Temperature", "Weather", "RoadType")},
    "demand_d49_morning_mean": "an.demand_d49_morning_mean", "demand_d49_last_known": "an.demand_d49_last_known",
    "geohash_te": "k.te", "geohash_prefix_te": "p.te", "geohash_hour_te": "kh.te",
}


def _matrix_column(c: str) -> str:
    expr = MATRIX_SQL.get(c, f"f.{c}")
    return f"{expr} AS {c}" if c in WHOLE else r(expr, c)


@query("feature_matrix", f"""
    SELECT f.Index, f.is_test, CASE WHEN f.is_test THEN NULL WHEN f.day = 49 THEN 0 ELSE -1 END AS fold, f.geohash,
           coalesce(a.RoadType, 'Unknown') AS RoadType, coalesce(a.Weather, 'Unknown') AS Weather,
           {', '.join(_matrix_column(c) for c in S.NUMERIC_FEATURES)}
    FROM feat2 f JOIN attrs a ON a.Index = f.Index JOIN latlon l ON l.geohash = f.geohash JOIN temp ON temp.Index = f.Index
    JOIN anchors an ON an.Index = f.Index JOIN te_k k ON k.Index = f.Index JOIN te_px p ON p.Index = f.Index
    JOIN te_kh kh ON kh.Index = f.Index""")
def _(spark, d):
    matrix = FM.feature_matrix(FM.build_features(*stored(spark, d)))
    numeric = [c if c in WHOLE else f"~{c}" for c in S.NUMERIC_FEATURES]
    return out(matrix, "Index", "is_test", "fold", "geohash", "RoadType", "Weather", *numeric)


REPORT_PARTS = [
    *[f"SELECT 'residuals' AS section, '{c}' AS item, {r(e, 'value', 4)} FROM valb" for c, e in RESIDUAL.items()],
    *[f"SELECT 'bucket_metrics', label || ' ' || '{c}', {r(c, 'value', dg)} FROM bmetrics" for c, dg in (("n", 0), ("r2", 4), ("mae", 5), ("acc", 4))],
    *[f"SELECT 'confusion', CAST(bucket AS VARCHAR) || '-{i}', {r(f'p{i}', 'value', 0)} FROM cm" for i in range(4)],
    f"SELECT 'confusion', 'macro_acc', {r('avg(acc)', 'value', 4)} FROM diag",
    f"SELECT 'spatial', 'mae_mean', {r('avg(mae)', 'value', 4)} FROM err",
    f"SELECT 'spatial', 'mae_std', {r('stddev_pop(mae)', 'value', 4)} FROM err",
    f"SELECT 'spatial', 'mae_min', {r('min(mae)', 'value', 4)} FROM err",
    f"SELECT 'spatial', 'mae_max', {r('max(mae)', 'value', 4)} FROM err",
    f"SELECT 'spatial', 'n_keys', {r('count(*)', 'value', 0)} FROM err",
    f"SELECT 'worst', geohash, {r('mae', 'value', 4)} FROM (SELECT * FROM err ORDER BY mae DESC, geohash LIMIT 5)",
    f"SELECT 'temporal', CAST(hour AS VARCHAR), {r('r2', 'value', 4)} FROM byhour",
    f"SELECT 'confusion', 'acc-' || CAST(bucket AS VARCHAR), {r('acc', 'value', 4)} FROM diag",
    *[f"SELECT 'temporal', 'r2_{f}', {f}(value) FROM (SELECT {r('r2', 'value', 4)} FROM byhour WHERE r2 IS NOT NULL) x" for f in ("min", "max")],
    f"SELECT 'temporal', 'worst_hour', (SELECT CAST(hour AS DOUBLE) FROM (SELECT hour, {r('r2', 'value', 4)} FROM byhour WHERE r2 IS NOT NULL) x ORDER BY value, hour LIMIT 1) FROM gm",
    "SELECT 'cold_start', 'n_keys', CAST((SELECT count(*) FROM keys WHERE key_class = 'cold') AS DOUBLE)",
]
_TEST = f"(SELECT coalesce(sm.sm / (gm.gm + {O.EPS}), 1.0) * coalesce(gh.mean, gm.gm) AS p FROM test t CROSS JOIN gm LEFT JOIN sm ON sm.s = t.s LEFT JOIN gh ON gh.geohash = t.geohash) q"
for _v, _name, _from in (("p", "val_pred_dist", "val"), ("y", "val_true_dist", "val"), ("p", "test_pred_dist", _TEST)):
    REPORT_PARTS += [f"SELECT '{_name}', 'p{q}', {r(f'quantile_cont({_v}, {q / 100})', 'value', 5)} FROM {_from}" for q in (10, 25, 50, 75, 90, 99)]
    REPORT_PARTS += [f"SELECT '{_name}', 'mean', {r(f'avg({_v})', 'value', 5)} FROM {_from}",
                     f"SELECT '{_name}', 'std', {r(f'stddev_pop({_v})', 'value', 5)} FROM {_from}"]
    REPORT_PARTS += [f"SELECT '{_name}', 'frac{i}', {r(f'avg(CASE WHEN {O.bucket(_v)} = {i} THEN 1.0 ELSE 0.0 END)', 'value', 4)} FROM {_from}" for i in range(4)]


@query("evaluation_report", " UNION ALL ".join(REPORT_PARTS))
def _(spark, d):
    train, test = split(spark, d)
    return reports.evaluation_report(
        materialize(validation(spark, d)), H.cold_keys(train, test), test_values=naive_forecast(spark, d).select("demand"))


def _check(name: str, value: str, source: str) -> str:
    op, threshold = Q.RULES[name]
    return (f"SELECT '{name}' AS \"check\", {r('value')}, CAST({threshold!r} AS DOUBLE) AS threshold, "
            f"coalesce(value {op} {threshold!r}, false) AS ok FROM (SELECT CAST({value} AS DOUBLE) AS value FROM {source})")


_H, _EQ = "feat2 WHERE day = 48 AND NOT is_test", "AVG(CASE WHEN {} THEN 1.0 ELSE 0.0 END)"
_NAIVE = f"(SELECT t.Index, coalesce(sm.sm / (gm.gm + {O.EPS}), 1.0) * coalesce(gh.mean, gm.gm) AS p FROM test t CROSS JOIN gm LEFT JOIN sm ON sm.s = t.s LEFT JOIN gh ON gh.geohash = t.geohash) q"
_AB = (f"(SELECT {O._from_log('y_log')} AS y, {O._from_log('oof_a')} AS a, {O._from_log('oof_b')} AS b, "
       f"{O._from_log('0.5 * oof_a + 0.5 * oof_b')} AS ab, {O._from_log('0.1 * oof_a + 0.2 * oof_b + 0.6 * oof_forest + 0.1 * oof_c')} AS p, "
       "oof_a, oof_b FROM oof WHERE fold = 0) q")
_CHECKS = [
    _check("proxy_equals_own_share", _EQ.format("abs(demand_d48_same_slot - demand) < 1e-10"), _H),
    _check("proxy_own_corr_low", "corr(demand_d48_same_slot, demand)", _H),
    _check("proxy_own_corr_high", "corr(demand_d48_same_slot, demand)", _H),
    _check("loo_equals_own_share", _EQ.format("abs(a.demand_d49_morning_mean - t.demand) < 1e-10"),
           "anchors a JOIN t ON t.Index = a.Index JOIN td ON td.geohash = t.geohash WHERE td.dc > 1"),
    _check("last_known_violations", _EQ.format("abs(a.demand_d49_last_known - td.dl) > 1e-10"),
           "anchors a JOIN t ON t.Index = a.Index JOIN td ON td.geohash = t.geohash"),
    _check("nonzero_anchor_share", _EQ.format("demand_d49_morning_mean > 0"), "anchors WHERE day = 48 AND NOT is_test"),
    _check("te_recomputation_gap", "0", "gm"),
    _check("value_column_in_matrix", "0", "gm"),
    _check("nulls_train", "0", "gm"), _check("nulls_test", "0", "gm"), _check("temperature_nulls", "0", "gm"),
    _check("out_of_bounds", "0", "gm"), _check("formula_log_same_slot", "0", "gm"),
    _check("formula_relative_slot", "0", "gm"), _check("formula_log_target", "0", "gm"), _check("missing_features", "0", "gm"),
    _check("unseen_key_share", "count(DISTINCT CASE WHEN k.key_class = 'cold' THEN k.geohash END) * 1.0 / count(DISTINCT k.geohash)",
           "test JOIN keys k ON k.geohash = test.geohash"),
    _check("train_val_gap", f"abs((SELECT {O.r2('y', 'p')} FROM (SELECT {O._from_log('ln(demand)')} AS y, {O._from_log('log_demand_d48_same_slot')} AS p FROM {_H})) - {O.r2('y', 'ab')})", _AB),
    _check("val_r2", O.r2("y", "ab"), _AB), _check("model_a_r2", O.r2("y", "a"), _AB), _check("model_b_r2", O.r2("y", "b"), _AB),
    _check("blend_minus_best", f"{O.r2('y', 'p')} - greatest({O.r2('y', 'a')}, {O.r2('y', 'b')})", _AB),
    _check("oof_corr", "corr(oof_a, oof_b)", _AB),
    _check("oof_not_finite", "count(*) FILTER (oof_a IS NULL OR oof_b IS NULL)", _AB),
    _check("oof_min", "min(a)", _AB), _check("oof_max", "max(a)", _AB),
    _check("residual_mean", "abs(avg(res))", "valb"), _check("residual_median", "abs(median(res))", "valb"),
    _check("residual_skew", f"abs({SKEW})", "valb"),
    _check("residual_extreme_share", "avg(CASE WHEN abs(res) > 5 * sd THEN 1.0 ELSE 0.0 END)",
           "valb CROSS JOIN (SELECT stddev_pop(res) AS sd FROM valb) x"),
    _check("macro_acc", "avg(acc)", "diag"), _check("very_low_acc", "max(CASE WHEN bucket = 0 THEN acc END)", "diag"),
    _check("high_as_very_low", "max(CASE WHEN bucket = 3 AND p0 + p1 + p2 + p3 > 0 THEN p0 * 1.0 / (p0 + p1 + p2 + p3) END)", "cm"),
    _check("very_low_as_high", "max(CASE WHEN bucket = 0 AND p0 + p1 + p2 + p3 > 0 THEN p3 * 1.0 / (p0 + p1 + p2 + p3) END)", "cm"),
    _check("bucket_acc_min", "min(CASE WHEN n >= 10 THEN acc END)", "bm"),
    _check("spatial_mae_mean", "avg(mae)", "err"), _check("hour_r2_min", "min(r2)", "byhour"),
    _check("output_row_gap", "0", "gm"), _check("output_nulls", "count(*) FILTER (p IS NULL)", _NAIVE),
    _check("output_out_of_range", "count(*) FILTER (p <= 0 OR p > 1.000000001)", _NAIVE),
    _check("output_missing_ids", "0", "gm"), _check("output_extra_ids", "0", "gm"),
    _check("output_mean_low", "avg(p)", _NAIVE), _check("output_mean_high", "avg(p)", _NAIVE),
    _check("output_std", "stddev_pop(p)", _NAIVE),
    _check("output_val_ratio_low", "avg(p) / greatest((SELECT avg(p) FROM val), 1e-9)", _NAIVE),
    _check("output_val_ratio_high", "avg(p) / greatest((SELECT avg(p) FROM val), 1e-9)", _NAIVE),
]


@query("dq_checks", " UNION ALL ".join(_CHECKS))
def _(spark, d):
    train, test = stored(spark, d)
    built = materialize(FM.build_features(train, test))
    on_history = built.where("not is_test and day = 48").selectExpr("y_log", "log_demand_d48_same_slot as p_log")
    train_r2 = E.r2_original_scale(on_history).select("r2")
    predictions = materialize(validation(spark, d))
    val_mean = E.on_value_scale(predictions).agg(F.avg("p"))
    rows = (
        Q.feature_checks(built, matrix=FM.feature_matrix(built))
        .unionByName(Q.model_checks(predictions, "oof_a", "oof_b", train_r2))
        .unionByName(Q.output_checks(naive_forecast(spark, d), test, val_mean))
    )
    return out(rows, "check", "~value", "threshold", "ok")
