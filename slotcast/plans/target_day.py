"""Autoregressive features of the target day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from slotcast.operators.encoding import leave_one_out, target_day_stats
from slotcast.operators.profile import grouped
from slotcast.plans.history import stack_rows
from slotcast.spec import DEFAULT, Spec


def anchor_columns(rows: DataFrame, overall: Column, sp: Spec = DEFAULT) -> DataFrame:
    """Morning mean and last known value for rows that carry their key's target-day stats.

    Labelled target-day rows leave themselves out of the mean. With no labelled target-day
    row at all (``overall`` is NULL) both columns are 0.
    """
    own_day = f"not is_test and {sp.day} = {sp.target_day}"
    loo = leave_one_out("day_sum", "day_cnt", sp.value, "_overall")
    return (
        rows.withColumn("_overall", overall)
        .selectExpr(
            "*",
            f"coalesce(case when {own_day} then {loo} else day_mean end, _overall, 0D) as demand_d49_morning_mean",
            "coalesce(day_last, _overall, 0D) as demand_d49_last_known",
        )
        .drop("day_sum", "day_cnt", "day_mean", "day_last", "_overall")
    )


def target_day_features(train: DataFrame, test: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    target = train.where(f"{sp.day} = {sp.target_day}")
    overall = grouped(target, [], m=f"avg({sp.value})").scalar()
    rows = stack_rows(train, test).join(target_day_stats(target, sp), sp.key, "left")
    return anchor_columns(rows, overall, sp)
