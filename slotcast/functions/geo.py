"""Geohash decoding as built-in expressions (SQL text) over the key column.

Read as a base-32 number a key is a string of bits; counted from the left, the bits at
even places are the longitude's and those at odd places the latitude's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotcast.spec import DEFAULT, Spec

# Fixed value: the geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# Fixed value: the digits of the number base 32 in their usual order.
BASE32_DIGITS = "0123456789abcdefghijklmnopqrstuv"
MAX_LENGTH = 24  # characters whose bits per axis fit a bigint
CHUNK = 12  # characters whose bits fit one conversion


def lon_bits(n: int) -> int:
    return (5 * n + 1) // 2


def lat_bits(n: int) -> int:
    return (5 * n) // 2


def normalized(key: str) -> str:
    """Lower-cased key; NULL when a character is not in the alphabet, an error beyond ``MAX_LENGTH`` characters."""
    too_long = f"cast(raise_error('a geohash has more than {MAX_LENGTH} characters') as string)"
    return (f"case when not lower({key}) rlike '^[{ALPHABET}]+$' then null "
            f"when length({key}) > {MAX_LENGTH} then {too_long} else lower({key}) end")


def _bits(part: str) -> str:
    return f"case when length({part}) > 0 then lpad(conv(translate({part}, '{ALPHABET}', '{BASE32_DIGITS}'), 32, 2), length({part}) * 5, '0') else '' end"


def with_cell_index(df: DataFrame, key: str) -> DataFrame:
    """Adds ``_k`` (normalized key) and its cell indices ``_lat``, ``_lon`` on the grid of its length."""
    head, tail = f"substring(_k, 1, {CHUNK})", f"substring(_k, {CHUNK + 1}, {CHUNK})"
    return (
        df.selectExpr("*", f"{normalized(key)} as _k")
        .selectExpr("*", f"concat({_bits(head)}, {_bits(tail)}) as _bits")
        .selectExpr(
            "*",
            "cast(conv(regexp_replace(_bits, '(.)(.)?', '$2'), 2, 10) as bigint) as _lat",
            "cast(conv(regexp_replace(_bits, '(.)(.)?', '$1'), 2, 10) as bigint) as _lon",
        )
        .drop("_bits")
    )


def with_lat_lon(df: DataFrame, key: str, round_digits: tuple[int, int] | None = None) -> DataFrame:
    """Adds the centre of the geohash cell in degrees; NULL for an invalid key."""
    lat = "-90D + (_lat + 0.5D) * 180D / pow(2D, floor(length(_k) * 5 / 2))"
    lon = "-180D + (_lon + 0.5D) * 360D / pow(2D, floor((length(_k) * 5 + 1) / 2))"
    if round_digits is not None:
        lat, lon = f"round({lat}, {round_digits[0]})", f"round({lon}, {round_digits[1]})"
    return with_cell_index(df, key).selectExpr("*", f"{lat} as lat", f"{lon} as lon").drop("_k", "_lat", "_lon")


def decode(df: DataFrame, sp: Spec = DEFAULT, round_digits: tuple[int, int] | None = None) -> DataFrame:
    """One row per distinct key with lat and lon; ``valid`` tells malformed keys apart."""
    return with_lat_lon(df.select(sp.key).distinct(), sp.key, round_digits).selectExpr(
        "*", "lat is not null as valid"
    )


def lattice_points(keys: DataFrame, sp: Spec = DEFAULT) -> DataFrame:
    """Valid keys as (id, x, y, ...): cell centres counted in half cells of the finest grid.

    Centres of keys of any length up to ``key_length`` are integers there; a longer key
    is an error. Other columns of ``keys`` are kept.
    """
    n = sp.key_length
    others = [c for c in keys.columns if c != sp.key]
    too_long = f"raise_error('a key is longer than key_length={n}')"
    size = f"case when length(_k) > {n} then cast({too_long} as int) else length(_k) end"
    return (
        with_cell_index(keys, sp.key).where("_k is not null")
        .selectExpr(f"{sp.key} as id", *others, "_lat", "_lon", f"{size} as _n")
        .selectExpr(
            "id",
            f"shiftleft(_lon * 2 + 1, cast({lon_bits(n)} - floor((_n * 5 + 1) / 2) as int)) as x",
            f"shiftleft(_lat * 2 + 1, cast({lat_bits(n)} - floor(_n * 5 / 2) as int)) as y",
            *others,
        )
    )
