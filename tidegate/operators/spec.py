"""What one source table looks like, and the conversion of its data to the target types."""

from __future__ import annotations

import decimal
import math
from collections.abc import Sequence
from dataclasses import astuple, dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.columns import type_columns


@dataclass(frozen=True)
class SourceColumn:
    """One column as the source describes it; numbers are text, '' means not given."""

    name: str
    source_type: str
    precision: str = ""
    scale: str = ""
    length: str = ""
    nullable: str = "Y"
    primary_key: str = "N"
    partition: str = "N"
    cluster: str = "N"


@dataclass(frozen=True)
class TargetColumn:
    """A source column with its target and Spark types settled."""

    name: str
    target_type: str
    type_text: str
    spark_type: str
    digits: int | None
    places: int | None
    length: int | None
    nullable: bool
    primary_key: bool
    partition: bool
    cluster: bool


# The catalog fields that describe one column, in the order of SourceColumn.
SPEC_FIELDS = [
    "column_name", "data_type", "data_precision", "data_scale", "char_length", "nullable",
    "is_primary_key", "partition_yn", "cluster_yn",
]


def _number(text: str | None) -> int | None:
    text = (text or "").strip()
    return int(text) if text.lstrip("+-").isdigit() else None


def target_columns(typed: DataFrame) -> list[TargetColumn]:
    """The spec of ONE table from its typed catalog rows (a bounded read: one row per column)."""
    rows = typed.select(*SPEC_FIELDS, "target_type", "type_text", "spark_type", "column_id")
    found = []
    for row in sorted(rows.collect(), key=lambda r: (r["column_id"], r["column_name"])):
        precision, scale = _number(row["data_precision"]), _number(row["data_scale"])
        found.append(
            TargetColumn(
                name=row["column_name"],
                target_type=row["target_type"],
                type_text=row["type_text"],
                spark_type=row["spark_type"],
                digits=precision,
                places=scale,
                length=_number(row["char_length"]),
                nullable=row["nullable"] != "N",
                primary_key=row["is_primary_key"].upper() == "Y",
                partition=row["partition_yn"].upper() == "Y",
                cluster=row["cluster_yn"].upper() == "Y",
            )
        )
    return found


@lru_cache(maxsize=256)
def _resolved(spec: tuple[SourceColumn, ...]) -> tuple[TargetColumn, ...]:
    spark = SparkSession.active()
    names = [*SPEC_FIELDS, "column_id"]
    cells = zip(*[(*astuple(column), place) for place, column in enumerate(spec, 1)])
    records = spark.createDataFrame(pa.table([pa.array(list(c)) for c in cells], names=names))
    return tuple(target_columns(type_columns(records)))


def resolve(spec: Sequence[SourceColumn]) -> tuple[TargetColumn, ...]:
    """Run the type rules over a hand-written spec. Same rules as for catalogs, on a local relation
    of one row per column, so no cluster job runs."""
    return _resolved(tuple(spec))


def table_spec(typed: DataFrame, schema_name: str, table_name: str) -> tuple[TargetColumn, ...]:
    """The spec of one catalog table."""
    one = (F.col("schema_name") == schema_name) & (F.col("table_name") == table_name)
    return tuple(target_columns(typed.filter(one)))


@dataclass(frozen=True)
class Fit:
    """Column expressions for one value: the converted value, whether it has no place in the
    target type, and whether digits were rounded away."""

    converted: Column
    misfit: Column
    rounded: Column


def fit(df: DataFrame, column: TargetColumn) -> Fit:
    """How the values of ``column`` fit their target type. NULL stays NULL and is no misfit."""
    value = F.col(f"`{column.name}`")
    source = df.schema[column.name].dataType
    held = T.DataType.fromDDL(column.spark_type)
    if isinstance(held, (T.LongType, T.DecimalType)):
        return _fit_number(value, source, held, column.places)
    never = F.lit(False)
    if isinstance(held, T.StringType):
        text = value.cast("string")
        if column.target_type in ("NUMERIC", "BIGNUMERIC"):
            return _fit_long_number(value, source, column)
        return Fit(text, never, never)
    if isinstance(held, T.BinaryType):
        plain = value if isinstance(source, (T.StringType, T.BinaryType)) else value.cast("string")
        return Fit(plain.cast("binary"), never, never)
    converted = value.try_cast(held)
    return Fit(converted, value.isNotNull() & converted.isNull(), never)


# Doubles below 2^53 count in steps of one, and 10^n is exact in a double up to n = 22.
EXACT_DOUBLE_INTEGERS = 2.0**53
EXACT_DOUBLE_POWER = 22
INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _fit_number(value: Column, source: T.DataType, held: T.DataType, places: int | None) -> Fit:
    whole_number = isinstance(held, T.LongType)
    scale = 0 if whole_number else held.scale
    whole_digits = 19 if whole_number else held.precision - held.scale
    if places is not None and places < 0:
        # A negative source scale rounds left of the point.
        return _fit_by_decimal(value, source, held, places, whole_digits)
    if type(source) in INTEGER_DIGITS:
        never = F.lit(False)
        misfit = never
        if INTEGER_DIGITS[type(source)] > whole_digits:
            limit = F.lit(10**whole_digits)
            misfit = F.coalesce((value >= limit) | (value <= -limit), never)
        return Fit(value.try_cast(held), misfit, never)
    if isinstance(source, T.DoubleType) and scale <= EXACT_DOUBLE_POWER:
        return _fit_double(value, held, scale, whole_digits)
    return _fit_by_decimal(value, source, held, scale, whole_digits)


def _fit_by_decimal(value: Column, source: T.DataType, held: T.DataType, round_to: int, whole_digits: int) -> Fit:
    """Round once, from the value as it is: a first rounding to a working type could make a tie of
    what is none. Digits count as lost where the rounded value differs from the whole one."""
    scale = max(round_to, 0)
    no = F.lit(False)
    wide = T.DecimalType(38, max(scale, min(38 - whole_digits, scale + 18)))
    if isinstance(source, T.DecimalType):
        rounded = F.round(value, round_to)
        # A value that no longer has room in its own type has grown by rounding.
        lost = F.coalesce(rounded.try_cast(source) != value, value.isNotNull()) if source.scale > round_to else no
    elif isinstance(source, T.StringType):
        if round_to >= 0:
            rounded = value.try_cast(T.DecimalType(38, scale))  # half up, from the text
        else:
            # Digits after the first one behind the point decide nothing left of it.
            rounded = F.round(F.regexp_replace(value, r"(\.[0-9])[0-9]+", "$1").try_cast(T.DecimalType(38, 1)), round_to)
        by_value = rounded.try_cast(wide) != value.try_cast(wide)
        lost = F.when(value.rlike("[eE]"), by_value).otherwise(_digits_beyond(value, scale))
        if round_to < 0:
            lost = lost | by_value
    else:
        rounded = value.try_cast(T.DecimalType(38, scale))
        if round_to < 0:
            rounded = F.round(value.try_cast(wide), round_to)
        lost = rounded.try_cast(wide) != value.try_cast(wide)
        if wide.scale <= scale:
            lost = F.round(value, round_to) != value
    converted = rounded.try_cast(held)
    misfit = value.isNotNull() & converted.isNull()
    return Fit(converted, misfit, F.coalesce(converted.isNotNull() & lost, no))


def _double_bound(whole_digits: int, scale: int) -> float:
    """The smallest double that rounds to ``whole_digits`` + 1 digits before the point."""
    limit = decimal.Decimal(10) ** whole_digits
    step = decimal.Decimal(1).scaleb(-scale)

    def overflows(number: float) -> bool:
        with decimal.localcontext(prec=400):
            return decimal.Decimal(repr(number)).quantize(step, decimal.ROUND_HALF_UP) >= limit

    bound = float(limit - step / 2)
    while not overflows(bound):
        bound = math.nextafter(bound, math.inf)
    while overflows(math.nextafter(bound, 0.0)):
        bound = math.nextafter(bound, 0.0)
    return bound


def _fit_double(value: Column, held: T.DataType, scale: int, whole_digits: int) -> Fit:
    """The same answers in double arithmetic, without a decimal object per value.

    A double stands for a number with ``scale`` places when it is the nearest double to
    k / 10^scale; below 2^53 that k is found exactly. Larger values are compared as decimals.
    """
    no = F.lit(False)
    power = F.lit(10.0**scale)
    lost = F.rint(value * power) / power != value
    by_decimal = _fit_by_decimal(value, T.DoubleType(), held, scale, whole_digits)
    if whole_digits + scale > 15:
        lost = F.when(F.abs(value) * power < F.lit(EXACT_DOUBLE_INTEGERS), lost).otherwise(by_decimal.rounded)
    # A cast that fails costs far more than one that succeeds, so misfits are kept from it.
    if isinstance(held, T.LongType):
        outside = F.isnan(value) | (value >= F.lit(2.0**63)) | (value < F.lit(-(2.0**63)))
        small = F.abs(value) < F.lit(EXACT_DOUBLE_INTEGERS)
        converted = F.when(small, by_decimal.converted).when(~outside, value.try_cast(held))
    else:
        outside = F.isnan(value) | (F.abs(value) >= F.lit(_double_bound(whole_digits, scale)))
        converted = F.when(~outside, value.try_cast(held))
    return Fit(converted, F.coalesce(outside, no), F.coalesce(~outside & lost, no))


def _digits_beyond(text: Column, scale: int) -> Column:
    """True when a plain decimal text has a digit other than 0 after ``scale`` places."""
    return text.rlike(rf"\.[0-9]{{{scale}}}[0-9]*[1-9]")


def _fit_long_number(value: Column, source: T.DataType, column: TargetColumn) -> Fit:
    """Numbers of more than 38 digits are kept as text; their digits are counted in the text."""
    # A double's own text may use an exponent; as a decimal it is written out.
    if isinstance(source, (T.DoubleType, T.FloatType)):
        text = F.coalesce(value.try_cast("decimal(38,9)").cast("string"), value.cast("string"))
    else:
        text = value.cast("string")
    scale = max(column.places or 0, 0)
    whole_digits = max(column.digits - scale, 0)
    shape = rf"\A\s*[+-]?0*[0-9]{{0,{whole_digits}}}(\.[0-9]*)?\s*\z"
    misfit = value.isNotNull() & ~text.rlike(shape)
    return Fit(text, misfit, F.coalesce(~misfit & _digits_beyond(text, scale), F.lit(False)))


def check_columns(df: DataFrame, spec: Sequence[TargetColumn], undeclared: str = "error") -> list[str]:
    """The columns of ``df`` that the spec does not name; raises when one of the spec is missing,
    or one is undeclared and that is an error."""
    if undeclared not in ("error", "drop", "keep"):
        raise ValueError(f"undeclared is error, drop or keep, not {undeclared!r}")
    declared = {column.name for column in spec}
    missing = sorted(declared - set(df.columns))
    extra = [c for c in df.columns if c not in declared]
    if missing:
        raise ValueError(f"columns of the spec that the data lacks: {', '.join(missing)}")
    if extra and undeclared == "error":
        raise ValueError(f"columns that the spec does not declare: {', '.join(extra)}")
    return extra


def convert_table(df: DataFrame, spec: Sequence[TargetColumn], undeclared: str = "error") -> DataFrame:
    """Cast every column of the spec to its target type in one pass; values that do not fit become
    NULL (``audits.fit_audit`` counts them, ``audits.quarantine`` keeps their rows).

    ``undeclared`` says what becomes of columns that the spec does not name: an ``error``, or
    ``drop`` them, or ``keep`` them as they are, after the others.
    """
    extra = check_columns(df, spec, undeclared)
    kept = [F.col(f"`{c}`") for c in extra] if undeclared == "keep" else []
    return df.select(*[fit(df, column).converted.alias(column.name) for column in spec], *kept)
