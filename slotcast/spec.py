"""Column names, days and constants every operator is parametrised with."""

from __future__ import annotations

from dataclasses import dataclass

# Category constants of the input schema.
LARGE_VEHICLES_ALLOWED = "Allowed"
LANDMARKS_YES = "Yes"
UNKNOWN = "Unknown"

# Value bucket edges (left-closed) and their labels.
BUCKET_EDGES = (0.03, 0.07, 0.15)
BUCKET_LABELS = (
    "very_low (<0.03)",
    "low (0.03-0.07)",
    "medium (0.07-0.15)",
    "high (>0.15)",
)

# The numeric and categorical columns of the feature matrix.
NUMERIC_FEATURES = (
    "minute_of_day", "hour",
    "mod_sin", "mod_cos", "mod_sin2", "mod_cos2", "mod_sin3", "mod_cos3",
    "lat", "lon",
    "NumberofLanes", "large_vehicles", "landmarks",
    "Temperature", "Temperature_missing", "Weather_missing", "RoadType_missing",
    "demand_d48_same_slot", "log_demand_d48_same_slot", "demand_d48_relative_slot",
    "demand_d48_geohash_mean", "demand_d48_geohash_std", "demand_d48_geohash_cv",
    "demand_d48_gh_hour_mean", "demand_d48_nearby_slots", "slot_shape",
    "demand_d48_log_geohash_mean", "demand_d48_geohash_p10", "demand_d48_geohash_p90",
    "demand_d48_expected", "demand_d48_gh_hour_rank",
    "demand_d48_prefix5_mean", "demand_d48_prefix4_mean",
    "demand_d48_prefix5_slot_mean", "demand_d48_prefix4_slot_mean",
    "demand_d48_spatial_neighbor_slot",
    "demand_d48_velocity", "demand_d48_acceleration",
    "demand_d48_slot_m30", "demand_d48_slot_p30",
    "demand_d48_rank_in_day",
    "demand_d49_morning_mean", "demand_d49_last_known",
    "geohash_te", "geohash_prefix_te", "geohash_hour_te",
)
CATEGORICAL_FEATURES = ("geohash", "RoadType", "Weather", "geohash_cluster")


@dataclass(frozen=True)
class Spec:
    """What the columns are called and which two days are compared.

    ``key_length`` is the longest geohash the key column holds; it fixes the
    integer lattice on which neighbour distances are exact.
    """

    row_id: str = "Index"
    key: str = "geohash"
    day: str = "day"
    timestamp: str = "timestamp"
    slot: str = "minute_of_day"
    hour: str = "hour"
    value: str = "demand"
    history_day: int = 48
    target_day: int = 49
    slot_minutes: int = 15
    day_minutes: int = 1440
    key_length: int = 6
    k_warm: int = 5
    k_cold: int = 3
    te_smoothing: int = 30
    n_clusters: int = 30
    eps: float = 1e-9
    clip_lo: float = 1e-6
    clip_hi: float = 1.0


DEFAULT = Spec()
