"""The full feature build: one grid, one wide row per key, one join back to the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast import spec as S
from slotcast.functions import geo
from slotcast.functions import scalar as X
from slotcast.operators import encoding as E
from slotcast.operators import profile as P
from slotcast.operators.impute import median_levels
from slotcast.plans import history as H
from slotcast.plans.target_day import anchor_columns
from slotcast.session import materialize
from slotcast.spec import DEFAULT, Spec

MATRIX_CELL_FEATURES = [c for c in S.NUMERIC_FEATURES if c in H.cell_features()]


def key_encodings(totals: DataFrame, prior: Column, sp: Spec = DEFAULT) -> DataFrame:
    """Per key its own encoding array and a map from hour to array, from (key, hour, fold) totals."""
    by_hour = E.encodings_by_fold(totals, [sp.key, sp.hour], 1, prior, sp.te_smoothing, "te", keep_sums=True)
    sums = P.grouped(by_hour, [sp.key], s="sum(s)", c="sum(c)", s0="sum(s0)", c0="sum(c0)",
                     te_hours=P.entries("te", sp.hour))
    return sums.select(sp.key, "te_hours", E.encoding_array(1, prior, sp.te_smoothing).alias("te_key"))


def temporal_totals(grid: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Log-value sums by (key, hour, fold) for the temporal fold, read from the grid."""
    return P.grouped(
        grid.where("not is_test"),
        [sp.key, f"{X.hour_of_slot(sp.slot)} as {sp.hour}", f"{X.temporal_fold(sp.day, sp)} as fold"],
        s="sum(log_total)", c="sum(n)",
    )


def encode_row(rows: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Time, category and missing-value columns that need nothing but the row.

    The two yes/no columns are replaced by their flags (names differ in case only).
    """
    replaced = {
        "Weather": X.fill_unknown("Weather"),
        "RoadType": X.fill_unknown("RoadType"),
        "NumberofLanes": X.required_int("NumberofLanes", "NumberofLanes"),
    }
    added = {
        "large_vehicles": X.flag("LargeVehicles", S.LARGE_VEHICLES_ALLOWED),
        "landmarks": X.flag("Landmarks", S.LANDMARKS_YES),
        "Temperature_missing": X.missing("Temperature"),
        "Weather_missing": X.missing("Weather"),
        "RoadType_missing": X.missing("RoadType"),
        **X.cyclic(sp.slot, period=sp.day_minutes),
    }
    return rows.selectExpr(
        *[f"{replaced[c]} as {c}" if c in replaced else f"`{c}`"
          for c in rows.columns if c not in ("LargeVehicles", "Landmarks")],
        *[f"{e} as {c}" for c, e in added.items()],
    )


def build_features(
    train: DataFrame, test: DataFrame, sp: Spec = DEFAULT, clusters: DataFrame | None = None,
    features: list[str] | None = None,
) -> DataFrame:
    """Training and unlabelled rows with every feature, ``fold``, ``y_log`` and ``is_test``.

    ``features`` names extra history columns beyond the matrix; ``clusters`` is a
    key -> geohash_cluster table, without which the label column is absent.
    """
    rows = H.stack_rows(train, test)
    grid = materialize(H.observation_grid(rows, sp, counted=["Temperature"]))
    prof = H.profile_of(grid, sp)
    cell_features = list(dict.fromkeys([*MATRIX_CELL_FEATURES, *(features or []), *H.ROW_INPUTS]))
    history = P.on_day(train, sp.history_day, sp)
    hour = X.hour_of_slot(sp.slot)

    on_target = f"not is_test and {sp.day} = {sp.target_day} and n > 0"
    keys = H.key_classes(
        grid, sp,
        day_sum=f"sum(case when {on_target} then total end)",
        day_cnt=f"sum(case when {on_target} then n end)",
        day_last=f"max_by(last, {sp.slot}) filter (where {on_target})",
    ).selectExpr("*", "try_divide(day_sum, day_cnt) as day_mean")
    day_overall = P.grouped(grid.where(on_target), [], m="try_divide(sum(total), sum(n))").scalar()

    totals = temporal_totals(grid, sp)
    prior = P.grouped(totals, [], p="sum(s) / sum(c)").scalar()
    px_totals = totals.selectExpr("*", f"substring({sp.key}, 1, 4) as _px")
    px_te = E.encodings_by_fold(px_totals, ["_px"], 1, prior, sp.te_smoothing, "te_prefix")

    medians = median_levels(train, "Temperature", sp)
    by_hour = P.grouped(medians["key_hour"], [sp.key], temp_hours=P.entries("median", sp.hour))

    wide = (
        H.entities(history, prof, keys, H.needs_of(cell_features, sp), sp)
        .join(key_encodings(totals, prior, sp), sp.key, "left")
        .selectExpr("*", f"substring({sp.key}, 1, 4) as _px").join(px_te, "_px", "left").drop("_px")
        .join(by_hour, sp.key, "left")
        .join(medians["key"].withColumnRenamed("median", "temp_key"), sp.key, "left")
    )
    keep = ["key_class", "lat", "lon", "day_sum", "day_cnt", "day_mean", "day_last", "te_key", "te_prefix",
            f"element_at(te_hours, {hour}) as te_hour",
            f"coalesce(element_at(temp_hours, {hour}), temp_key) as temp_fill"]
    if clusters is not None:
        wide = wide.join(clusters.select(sp.key, "geohash_cluster"), sp.key, "left")
        keep.append("geohash_cluster")
    wide = materialize(geo.with_lat_lon(wide, sp.key), sp.key)
    cell = H.cells(wide, prof, cell_features, sp, keep=keep)

    out = H.row_features(H.join_cells(rows, cell, sp), sp)
    out = encode_row(anchor_columns(out, day_overall, sp), sp)
    return (
        out.withColumn("Temperature", F.coalesce("Temperature", "temp_fill", medians["global"].scalar()))
        .selectExpr(
            "*",
            f"demand_d49_morning_mean / (demand_d48_geohash_mean + {sp.eps!r}D) as demand_d49_d48_ratio",
            f"case when not is_test then {X.temporal_fold(sp.day, sp)} end as fold",
            f"{X.log_value(sp.value, sp)} as y_log",
        )
        .withColumns({
            "geohash_te": E.for_fold("te_key", prior),
            "geohash_prefix_te": E.for_fold("te_prefix", prior),
            "geohash_hour_te": E.for_fold("te_hour", prior),
        })
        .drop("te_key", "te_prefix", "te_hour", "temp_fill")
    )


def feature_matrix(built: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Row id plus the declared features, categories as strings; the value column is not among them."""
    categories = [c for c in S.CATEGORICAL_FEATURES if c in built.columns]
    return built.selectExpr(
        sp.row_id, "is_test", "fold", *S.NUMERIC_FEATURES, *[f"cast({c} as string) as {c}" for c in categories]
    )
