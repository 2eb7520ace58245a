"""Observation table of the demand schema derived from the ``events`` table.

Users become locations, days of the month 1-15 the history day and 16-31 the target
day. The result has the columns of the input schema plus ``key_class`` and ``split``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotcast.functions.geo import ALPHABET
from slotcast.session import materialize
from slotcast.sources.tables import with_time


def _char(index: str) -> str:
    return f"substring('{ALPHABET}', cast(1 + {index} as int), 1)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .selectExpr(
            "user_id", "value", "event_type",
            "case when dayofmonth(ts) <= 15 then 48 else 49 end as day",
            "hour(ts) * 60 + minute(ts) - minute(ts) % 15 as slot",
            "cast(regexp_extract(props, '[0-9]+', 0) as int) as kk",
        )
        .groupBy("user_id", "day", "slot")
        .agg({"value": "avg", "event_type": "min", "kk": "min"})
    )
    key = ", ".join([
        # q and p for the first 32,000 users, then the next characters; six hold 32 * 32 * 32,000 users
        _char(f"(22 + floor(user_id / {32_000 * 32})) % 32"), _char("(21 + floor(user_id / 32000)) % 32"),
        _char("floor(user_id / 1000) % 32"), _char("floor(user_id / 100) % 10"),
        _char("floor(user_id / 10) % 10"), _char("user_id % 10"),
    ])
    return cells.selectExpr(
        "cast((user_id * 2 + day - 48) * 1440 + slot as bigint) as Index",
        f"case when user_id < {32_000 * 32 * 32} then concat({key}) else cast(raise_error('too many users for six characters') as string) end as geohash",
        "day",
        "concat(cast(floor(slot / 60) as string), ':', cast(slot % 60 as string)) as timestamp",
        """case when user_id % 7 = 0 then null when user_id % 7 in (1, 2) then 'Highway'
                when user_id % 7 = 3 then 'Residential' else 'Street' end as RoadType""",
        "cast(1 + user_id % 5 as int) as NumberofLanes",
        "case when user_id % 2 = 0 then 'Allowed' else 'Not Allowed' end as LargeVehicles",
        "case when user_id % 3 = 0 then 'Yes' else 'No' end as Landmarks",
        "case when `min(kk)` % 20 <> 0 then `min(kk)` / 2D end as Temperature",
        """case `min(event_type)` when 'click' then 'Sunny' when 'error' then null
                when 'purchase' then 'Rainy' when 'signup' then 'Snowy' else 'Foggy' end as Weather""",
        "round(greatest(least(`avg(value)` / 500, 1D), 1e-6D), 8) as demand",
        """case when user_id % 37 = 0 then 'cold' when user_id % 41 = 1 then 'target_only'
                else 'warm' end as key_class""",
        """case when day = 48 and user_id % 37 <> 0 and user_id % 41 <> 1 then 'train'
                when day = 49 and slot <= 120 and user_id % 37 <> 0 then 'train'
                when day = 49 and slot > 120 then 'test' end as split""",
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with parsed time columns."""
    return _labelled(observations(spark, sf_dir))


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to predict: the value column is not part of them."""
    return _unlabelled(observations(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both, read from one stored observation table; for dataflows that scan the rows several times."""
    rows = materialize(observations(spark, sf_dir).drop("key_class"))
    return _labelled(rows), _unlabelled(rows)


def _labelled(rows: DataFrame) -> DataFrame:
    return with_time(rows.where("split = 'train'").drop("key_class", "split"))


def _unlabelled(rows: DataFrame) -> DataFrame:
    return with_time(rows.where("split = 'test'").drop("key_class", "split", "demand"))
