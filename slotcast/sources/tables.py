"""Scans of observation tables and run logs with fixed schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast.functions import scalar as X
from slotcast.spec import DEFAULT, Spec

_ATTRIBUTES = [
    T.StructField("Index", T.LongType()),
    T.StructField("geohash", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("RoadType", T.StringType()),
    T.StructField("NumberofLanes", T.IntegerType()),
    T.StructField("LargeVehicles", T.StringType()),
    T.StructField("Landmarks", T.StringType()),
    T.StructField("Temperature", T.DoubleType()),
    T.StructField("Weather", T.StringType()),
]
UNLABELLED_SCHEMA = T.StructType(_ATTRIBUTES)
LABELLED_SCHEMA = T.StructType([*_ATTRIBUTES, T.StructField("demand", T.DoubleType())])

RUN_SCHEMA = (
    "ts string, lb double, blend_calib double, blend_raw double, lgbm double, cat double, et double, "
    "w struct<lgbm: double, cat: double, et: double, xgb: double>, calib_ab array<double>, "
    "val_r2 double, train_r2 double, n_feat bigint, n_train bigint, n_val bigint, "
    "pred_mean double, pred_std double, pred_min double, pred_max double, note string, "
    "eval struct<res_mean: double, res_std: double, macro_acc: double, "
    "bucket_r2: struct<very_low: double, low: double, medium: double, high: double>, "
    "spatial_mae_mean: double, spatial_mae_max: double, worst_geo_mae: double, "
    "spatial_r2_mean: double, spatial_r2_min: double, worst_geo_r2: double, "
    "test_pred_mean: double, test_pred_std: double, cold_start: bigint>"
)


# Texts that stand for a missing value in the input files.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)


def _typed(field: T.StructField) -> str:
    """SQL for a column read as text: its typed value, NULL where missing, an error where it is no such value."""
    name, kind = f"`{field.name}`", field.dataType.simpleString()
    missing = f"{name} is null or trim({name}) in ({', '.join(map(repr, MISSING))})"
    if field.dataType == T.StringType():
        return f"case when {missing} then null else {name} end as {name}"
    wrong = f"raise_error(concat('column {field.name}: not a {kind}: ', {name}))"
    value = f"try_cast({name} as {kind})"
    if field.dataType in (T.IntegerType(), T.LongType()):  # whole numbers may be written with a fraction of zero
        value = f"coalesce({value}, case when try_cast({name} as double) % 1 = 0 then try_cast(try_cast({name} as double) as {kind}) end)"
    return f"case when {missing} then null else coalesce({value}, cast({wrong} as {kind})) end as {name}"


def read_observations(spark: SparkSession, path: str, labelled: bool = True, fmt: str = "csv") -> DataFrame:
    """Observation rows, columns by their names in the header; NaN values become NULL so that averages skip them.

    Files may have the columns in any order and others besides; a missing column or a value
    that is not of its column's type is an error.
    """
    schema = LABELLED_SCHEMA if labelled else UNLABELLED_SCHEMA
    if fmt == "csv":
        df = spark.read.csv(path, header=True, enforceSchema=False).selectExpr(*map(_typed, schema))
    else:
        df = spark.read.format(fmt).load(path).select(*[F.col(f.name).cast(f.dataType) for f in schema])
    return df.withColumns(
        {f.name: F.nanvl(f.name, F.lit(None).cast("double")) for f in schema if f.dataType == T.DoubleType()}
    )


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of run records; blank lines and lines that are not JSON are skipped, a missing path is empty.

    A field of another type than expected is NULL, the rest of its record stays.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUN_SCHEMA)
    readable = F.from_json("value", "map<string, string>", {"mode": "PERMISSIVE"}).isNotNull()
    whole = F.rtrim("value").endswith("}")
    return lines.where(readable & whole).select(F.from_json("value", RUN_SCHEMA).alias("r")).select("r.*")


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Stored table, or an empty one of the schema where none was written."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_time(df: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Adds hour, minute and slot parsed from the ``H:M`` timestamp."""
    parsed = df.selectExpr(
        "*", f"{X.hour_of_timestamp(sp.timestamp)} as {sp.hour}", f"{X.minute_of_timestamp(sp.timestamp)} as minute"
    )
    return parsed.selectExpr("*", f"{sp.hour} * 60 + minute as {sp.slot}")
