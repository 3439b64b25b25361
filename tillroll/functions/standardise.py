"""Turn typed source values into the landing table's plain texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: every character that counts as white space, not only the ASCII ones.
WHITE_SPACE = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TIDY = r"^-?(0|[1-9]\d*)(\.\d+)?\z"
_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_EXPONENT = r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$"


def strip(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(text, f"^{WHITE_SPACE}|{WHITE_SPACE}$", "")


def norm_text(value: Column) -> Column:
    """Null to '', white-space runs to one blank, ends stripped."""
    one_blank = F.regexp_replace(value.cast("string"), WHITE_SPACE, " ")
    return F.coalesce(F.trim(one_blank), F.lit(""))


def norm_id(value: Column, data_type: T.DataType) -> Column:
    """Identifier text: null to '', whole floating numbers without '.0', other values stripped."""
    if isinstance(data_type, T.BooleanType):
        text = F.initcap(value.cast("string"))
    elif isinstance(data_type, _INTEGRAL):
        text = value.cast("string")
    elif isinstance(data_type, _FLOATING):
        shortest = value.cast("string")
        whole = shortest.try_cast("decimal(38,0)").cast("string")
        plain = F.regexp_replace(shortest.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
        text = F.coalesce(F.when(value == F.rint(value), whole).otherwise(plain), shortest)
    else:
        text = strip(value.cast("string"))
    return F.coalesce(text, F.lit(""))


def _tidy(number: Column) -> Column:
    """Plain number text without plus sign, superfluous leading zeros or bare points; scale is kept."""
    number = F.regexp_replace(number, r"^\+", "")
    number = F.regexp_replace(number, r"^(-?)\.", "$10.")
    number = F.regexp_replace(number, r"^(-?)0+(?=\d)", "$1")
    return F.regexp_replace(number, r"\.$", "")


def _write_out(text: Column) -> Column:
    """Exponent notation with the point moved to its place; exact at any precision."""

    def move(part: Column) -> Column:
        digits, point = part["digits"], F.length(part["whole"]) + part["shift"]
        left = F.repeat(F.lit("0"), F.greatest(F.lit(0), -point))
        right = F.repeat(F.lit("0"), F.greatest(F.lit(0), point - F.length(digits)))
        padded = F.concat(left, digits, right)
        cut = F.greatest(point, F.lit(0))
        before, after = F.substring(padded, F.lit(1), cut), F.substring(padded, cut + 1, F.length(padded))
        return _tidy(F.concat(part["sign"], before, F.lit("."), after))

    mantissa, exponent = F.split(text, "[eE]")[0], F.split(text, "[eE]")[1]
    part = F.struct(
        F.regexp_extract(mantissa, "^-?", 0).alias("sign"),
        F.regexp_extract(mantissa, r"^[+-]?(\d*)", 1).alias("whole"),
        F.regexp_replace(mantissa, r"[+.-]", "").alias("digits"),
        F.regexp_replace(exponent, r"^\+", "").try_cast("int").alias("shift"),
    )
    # One-element transform: binds the parts once instead of repeating their expressions.
    return F.transform(F.array(part), move)[0]


def norm_decimal(value: Column, on_error: str = "raise", data_type: T.DataType | None = None) -> Column:
    """Blank to '', numbers to plain notation; other text fails the job, or gives null with 'null'.

    Floating numbers get their shortest digits; whole ones below 1e16 end in '.0', larger ones do not.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    if isinstance(data_type, _FLOATING):
        shortest = F.regexp_replace(value.cast("string"), r"\.0(E|$)", "$1")
        plain = norm_decimal(shortest, on_error)
        return F.when((value == F.rint(value)) & (F.abs(value) < 1e16), F.concat(plain, F.lit(".0"))).otherwise(plain)
    text = F.coalesce(strip(value.cast("string")), F.lit(""))
    bad = (
        F.lit(None).cast("string")
        if on_error == "null"
        else F.raise_error(F.concat(F.lit("Invalid decimal value: "), text)).cast("string")
    )
    # Most texts are plain numbers as they stand; one look at them spares the replacements.
    given = value.cast("string")
    return (
        F.when(given.rlike(_TIDY), given)
        .when(text == "", F.lit(""))
        .when(text.rlike(_PLAIN), _tidy(text))
        .when(text.rlike(_EXPONENT), _write_out(text))
        .otherwise(bad)
    )


def norm_ts(value: Column, data_type: T.DataType) -> Column:
    """Timestamps and dates as 'yyyy-MM-dd HH:mm:ss', null to '', other values stripped."""
    if isinstance(data_type, T.DateType):
        text = F.concat(value.cast("string"), F.lit(" 00:00:00"))
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = F.substring(value.cast("string"), 1, 19)
    else:
        text = strip(value.cast("string"))
    return F.coalesce(text, F.lit(""))
