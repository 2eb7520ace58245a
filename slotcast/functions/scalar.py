"""Row-level expressions as Spark SQL text: time, flags, logs, buckets, rounding.

Every function takes SQL text (a column name or any expression) and returns SQL text for
``selectExpr`` or ``F.expr``.
"""

from __future__ import annotations

import math

from slotcast import spec as S
from slotcast.spec import DEFAULT, Spec


# --- time -------------------------------------------------------------------

def hour_of_timestamp(ts: str) -> str:
    return f"cast(split({ts}, ':')[0] as int)"


def minute_of_timestamp(ts: str) -> str:
    return f"cast(split({ts}, ':')[1] as int)"


def hour_of_slot(slot: str) -> str:
    return f"cast(floor(({slot}) / 60) as int)"


def cyclic(slot: str, harmonics: int = 3, period: int = 1440) -> dict[str, str]:
    """sin/cos pairs named mod_sin, mod_cos, mod_sin2, mod_cos2, ..."""
    out: dict[str, str] = {}
    for h in range(1, harmonics + 1):
        suffix = "" if h == 1 else str(h)
        angle = f"({slot}) * {2.0 * math.pi * h / period!r}D"
        out[f"mod_sin{suffix}"] = f"sin({angle})"
        out[f"mod_cos{suffix}"] = f"cos({angle})"
    return out


# --- categories ---------------------------------------------------------------

def flag(c: str, expected: str) -> str:
    """1 where equal, 0 otherwise; null counts as not equal."""
    return f"cast(coalesce({c} = '{expected}', false) as int)"


def missing(c: str) -> str:
    return f"cast({c} is null as int)"


def fill_unknown(c: str) -> str:
    return f"coalesce(cast({c} as string), '{S.UNKNOWN}')"


def required_int(c: str, name: str) -> str:
    """Integer cast in which a null is an error, not a value."""
    return f"case when {c} is null then cast(raise_error('{name} must not be null') as int) else cast({c} as int) end"


def to_number(c: str) -> str:
    """Numeric reading of any column; what does not parse is 0."""
    return f"coalesce(try_cast({c} as double), 0D)"


# --- value scale ----------------------------------------------------------------

def _double(x: float) -> str:
    return f"{x!r}D"


def log_value(value: str, sp: Spec = DEFAULT) -> str:
    """Log of a positive value; a value <= 0 is clipped to the lower bound first."""
    return f"case when ({value}) is not null then ln(greatest({value}, {_double(sp.clip_lo)})) end"


def clip_value(value: str, sp: Spec = DEFAULT) -> str:
    lo, hi = _double(sp.clip_lo), _double(sp.clip_hi)
    return f"case when ({value}) is not null then greatest(least({value}, {hi}), {lo}) end"


def from_log(log_value: str, sp: Spec = DEFAULT) -> str:
    return clip_value(f"exp({log_value})", sp)


def floored_log(value: str, sp: Spec = DEFAULT) -> str:
    return f"ln(greatest({value}, {_double(sp.eps)}))"


def bucket(value: str, edges: tuple[float, ...] = S.BUCKET_EDGES) -> str:
    """Index of the left-closed bucket the value falls into."""
    tests = " ".join(f"when ({value}) < {edge!r}D then {i}" for i, edge in enumerate(edges))
    return f"case when ({value}) is null then null {tests} else {len(edges)} end"


def bucket_label(index: str, labels: tuple[str, ...] = S.BUCKET_LABELS) -> str:
    return "element_at(array({}), ({}) + 1)".format(", ".join(f"'{x}'" for x in labels), index)


# --- folds ------------------------------------------------------------------------

def temporal_fold(day: str, sp: Spec = DEFAULT) -> str:
    """0 for the target day (validation), -1 for everything else (training)."""
    return f"case when {day} = {sp.target_day} then 0 else -1 end"


# --- reporting ----------------------------------------------------------------------

# A mean of a few short decimals often lies exactly halfway between two rounded
# values, where float noise decides. The shift moves such ties off the halfway point.
TIE_SHIFT = 3.14159e-11


def rounded(value: str, digits: int = 6) -> str:
    return f"round(cast({value} as double) + {TIE_SHIFT!r}D, {digits}) + 0D"
