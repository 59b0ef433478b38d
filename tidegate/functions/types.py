"""Source type -> target type -> Spark type, as column expressions.

The steps are meant to be chained over several ``select``/``withColumns`` calls (see
``operators.columns.type_columns``), so that each parsed number is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.text import WHITE_SPACE, strip

# Target type of each source type that needs no precision or scale.
PLAIN_TYPES = {
    "VARCHAR2": "STRING",
    "CHAR": "STRING",
    "NVARCHAR2": "STRING",
    "NCHAR": "STRING",
    "CLOB": "STRING",
    "NCLOB": "STRING",
    "LONG": "STRING",
    "BLOB": "BYTES",
    "RAW": "BYTES",
    "DATE": "DATETIME",
    "INTEGER": "INT64",
    "FLOAT": "FLOAT64",
}

# Digit limits of the target's number types.
INT64_DIGITS = 18
NUMERIC_WHOLE_DIGITS = 29
NUMERIC_DIGITS, NUMERIC_SCALE = 38, 9
BIGNUMERIC_DIGITS, BIGNUMERIC_SCALE = 76, 38
SPARK_DIGITS = 38

INTEGER_TEXT = r"\A[+-]?[0-9]+\z"
PADDED_INTEGER_TEXT = rf"\A{WHITE_SPACE}*[+-]?[0-9]+{WHITE_SPACE}*\z"
BLANK_TEXT = rf"\A{WHITE_SPACE}*\z"


def parse_int(text: Column) -> Column:
    """The integer written in ``text``; NULL when it is blank or anything else.

    The pattern comes first: a cast that fails costs far more than one that succeeds.
    """
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint")).when(
        text.rlike(PADDED_INTEGER_TEXT), strip(text).try_cast("bigint")
    )


def is_broken_int(text: Column, parsed: Column) -> Column:
    """True when ``text`` is not blank and ``parsed``, its ``parse_int``, found no integer."""
    return F.coalesce(parsed.isNull() & (text != "") & ~text.rlike(BLANK_TEXT), F.lit(False))


def base_type(source_type: Column) -> Column:
    """The type name in upper case, up to the first parenthesis; spaces are kept."""
    return F.substring_index(F.upper(source_type), "(", 1)


def target_type(base: Column, precision: Column, scale: Column) -> Column:
    """The bare target type. ``precision`` and ``scale`` are parsed integers or NULL."""
    whole = (
        F.when(precision <= INT64_DIGITS, "INT64")
        .when(precision <= NUMERIC_WHOLE_DIGITS, "NUMERIC")
        .otherwise("BIGNUMERIC")
    )
    fraction = (
        F.when(precision.isNull(), "NUMERIC")
        .when((precision <= NUMERIC_DIGITS) & (scale <= NUMERIC_SCALE), "NUMERIC")
        .when((precision <= BIGNUMERIC_DIGITS) & (scale <= BIGNUMERIC_SCALE), "BIGNUMERIC")
        .otherwise("STRING")
    )
    number = F.when(scale == 0, whole).when(scale > 0, fraction).otherwise("NUMERIC")
    names_of: dict[str, list[str]] = {}
    for name, target in PLAIN_TYPES.items():
        names_of.setdefault(target, []).append(name)
    chain = F.when(base == "NUMBER", number).when(F.startswith(base, F.lit("TIMESTAMP")), "DATETIME")
    for target, names in names_of.items():
        chain = chain.when(base.isin(*names), target)
    return chain.otherwise("STRING")


def type_text(
    target: Column,
    precision: Column,
    scale: Column,
    length: Column,
    string_mode: str = "auto",
    preserve_string_length: bool = False,
) -> Column:
    """The target type with its arguments, as written in a table definition.

    ``precision``, ``scale`` and ``length`` are parsed integers; the caller passes all three as
    NULL when any of the three texts is broken.
    """
    too_big = (
        F.when(scale.isNull(), precision > NUMERIC_WHOLE_DIGITS)
        .when(scale == 0, precision > NUMERIC_WHOLE_DIGITS)
        .otherwise((precision > NUMERIC_DIGITS) | (scale > NUMERIC_SCALE))
    )
    kind = F.when((target == "NUMERIC") & too_big, "BIGNUMERIC").otherwise(target)
    arguments = F.concat_ws(", ", precision.cast("string"), scale.cast("string"))
    text = F.when(
        target.isin("NUMERIC", "BIGNUMERIC") & precision.isNotNull(),
        F.concat(kind, F.lit("("), arguments, F.lit(")")),
    )
    if preserve_string_length and string_mode != "string_only":
        text = text.when(
            (target == "STRING") & length.isNotNull(),
            F.concat(F.lit("STRING("), length.cast("string"), F.lit(")")),
        )
    return text.otherwise(target)


def spark_type(target: Column, precision: Column, scale: Column) -> Column:
    """The Spark type that holds the target type, as a DDL string.

    Spark decimals stop at 38 digits and take no negative scale: longer numbers stay text, and a
    negative scale widens the integer part.
    """

    def decimal(digits: Column, places: Column) -> Column:
        return F.concat(
            F.lit("decimal("), digits.cast("string"), F.lit(","), places.cast("string"), F.lit(")")
        )

    zero = F.lit(0).cast("bigint")
    at_least_one = F.greatest(precision, F.lit(1).cast("bigint"))
    number = (
        F.when(precision.isNull(), F.when(scale <= 0, "decimal(38,0)").otherwise("decimal(38,9)"))
        .when(scale < 0, decimal(F.least(at_least_one - scale, F.lit(SPARK_DIGITS).cast("bigint")), zero))
        .when(precision > SPARK_DIGITS, "string")
        .when(scale > 0, decimal(F.greatest(precision, scale), scale))
        .otherwise(decimal(at_least_one, zero))
    )
    return (
        F.when(target.isin("NUMERIC", "BIGNUMERIC"), number)
        .when(target == "INT64", "bigint")
        .when(target == "FLOAT64", "double")
        .when(target == "DATETIME", "timestamp_ntz")
        .when(target == "BYTES", "binary")
        .otherwise("string")
    )
