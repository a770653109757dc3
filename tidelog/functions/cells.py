"""Text cells to typed columns, by source type number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type number -> Spark type without facets.
TYPE_BY_OID = {
    16: T.BooleanType(),
    17: T.BinaryType(),
    20: T.LongType(),
    21: T.ShortType(),
    23: T.IntegerType(),
    114: T.VariantType(),
    701: T.DoubleType(),
    1043: T.StringType(),
    1082: T.DateType(),
    1083: T.TimeType(6),
    1114: T.TimestampNTZType(),
    1184: T.TimestampType(),
    1700: T.DecimalType(38, 18),
    3802: T.VariantType(),
}

# Words accepted for a boolean.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")


def spark_type(oid: int, typmod: int = -1) -> T.DataType:
    """Spark type of a source column; unknown numbers are text."""
    if typmod != -1 and oid == 1700:
        packed = typmod - 4
        precision, scale = (packed >> 16) & 65535, packed & 65535
        # Wider numbers than Spark's keep their text.
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    if typmod != -1 and oid == 1083:
        return T.TimeType(min(typmod, 6))
    return TYPE_BY_OID.get(oid, T.StringType())


def try_typed(cell: Column, dtype: T.DataType) -> Column:
    """Cast a text cell, giving NULL where the text is not a value of the type."""
    if isinstance(dtype, T.StringType):
        return cell
    if isinstance(dtype, T.BinaryType):
        return F.when(cell.startswith("\\x"), F.try_to_binary(F.substr(cell, F.lit(3)), F.lit("hex")))
    if isinstance(dtype, T.VariantType):
        return F.try_parse_json(cell)
    if isinstance(dtype, T.BooleanType):
        words = [F.lit(v) for w in TRUE_WORDS for v in (w, True)]
        words += [F.lit(v) for w in FALSE_WORDS for v in (w, False)]
        return F.try_element_at(F.create_map(*words), F.lower(F.trim(cell)))
    if isinstance(dtype, T.DecimalType):
        # A number that would be rounded is no value of the type.
        exact = ~cell.rlike(rf"\.\d{{{dtype.scale}}}\d*[1-9]") | cell.rlike("[eE]")
        return F.when(exact, cell.try_cast(dtype))
    return cell.try_cast(dtype)


def failed_cast(raw: Column, typed: Column) -> Column:
    """True where a value was given but is not of the type (a NULL is no failure)."""
    return raw.isNotNull() & typed.isNull()
