"""Scalar functions for log positions, source epochs and type modifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: microseconds between 1970-01-01 and the source's epoch 2000-01-01.
EPOCH_2000_MICROS = 946684800000000

# Hexadecimal log position, two halves of up to 32 bits each.
HEX_LSN = r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"


def lsn_to_hex(lsn: Column) -> Column:
    """64-bit position to ``X/XXXXXXXX``."""
    high = F.hex(F.shiftright(lsn, 32))
    low = F.lpad(F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.concat(high, F.lit("/"), low)


def lsn_from_hex(text: Column) -> Column:
    """``X/X`` to a 64-bit position; anything else gives NULL."""
    halves = F.split(text, "/")
    high = F.conv(F.get(halves, F.lit(0)), 16, 10).cast("bigint")
    low = F.conv(F.get(halves, F.lit(1)), 16, 10).cast("bigint")
    return F.when(text.rlike(HEX_LSN), F.shiftleft(high, 32).bitwiseOR(low))


def from_epoch_2000(micros: Column) -> Column:
    """Microseconds since 2000-01-01 UTC to a zone-free timestamp."""
    return F.timestamp_micros(micros + F.lit(EPOCH_2000_MICROS)).cast("timestamp_ntz")


def to_epoch_2000(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) - F.lit(EPOCH_2000_MICROS)


def numeric_precision(typmod: Column) -> Column:
    """Precision packed in a numeric column's type modifier; -1 means unbounded."""
    packed = F.shiftright(typmod - 4, 16).bitwiseAND(F.lit(65535))
    return F.when(typmod != -1, packed)


def numeric_scale(typmod: Column) -> Column:
    return F.when(typmod != -1, (typmod - 4).bitwiseAND(F.lit(65535)))
