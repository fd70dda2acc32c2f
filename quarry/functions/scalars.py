"""Small scalar helpers: address extraction, first-character ranges, byte XOR,
fixed-width formatting (inventory I11, I17-I19, I24, B7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: address prefix pattern (three "digits + any one character" groups,
# then digits; the dot is deliberately unescaped).
ADDRESS_PATTERN = r"(^(([0-9]*).){3}[0-9]*)"

# The ten static key ranges, by first character of the key, in
# bucket order 0..9. A key whose first character is in none of them goes to 0.
STATIC_RANGES = (
    "0123456",
    "789ABCD",
    "EFGHIJ",
    "KLMNOP",
    "QRSTUV",
    "WXYZab",
    "cdefgh",
    "ijklmn",
    "opqrst",
    "uvwxyz",
)

# Fixed value: report line layout (name, count, top item, top value).
REPORT_FORMAT = "%-15s %-10d %-50s %-10s"


def address_prefix(s: Column) -> Column:
    """Leading address without its port; null when nothing matches."""
    return F.nullif(F.regexp_extract(s, ADDRESS_PATTERN, 0), F.lit(""))


def static_range_bucket(key: Column) -> Column:
    first = F.substring(key, 1, 1)
    expr = None
    for b, chars in enumerate(STATIC_RANGES):
        cond = first.isin(*list(chars))
        expr = F.when(cond, F.lit(b)) if expr is None else expr.when(cond, F.lit(b))
    return expr.otherwise(F.lit(0))


def xor_of_bytes(data: Column) -> Column:
    """XOR of all bytes of a binary value, as a signed byte (-128..127).

    The hex form is cut into 7-byte words with one linear regex pass, the words
    are XOR-folded as longs, and the seven byte lanes of the result are folded
    last. XOR is associative, so this equals folding byte by byte.
    """
    return fold_byte_lanes(xor_fold_words(data))


def xor_fold_words(data: Column) -> Column:
    """XOR of the 7-byte words of a binary value (a long whose 7 lanes hold the
    XOR of the bytes at each position mod 7)."""
    words = F.regexp_extract_all(F.hex(data), F.lit("(.{1,14})"), 1)
    return F.aggregate(words, F.lit(0).cast("long"),
                       lambda acc, w: acc.bitwiseXOR(F.conv(w, 16, 10).cast("long")))


def fold_byte_lanes(folded: Column) -> Column:
    """XOR the seven byte lanes of ``xor_fold_words`` into one signed byte."""
    lanes = folded.bitwiseAND(255)
    for k in range(1, 7):
        lanes = lanes.bitwiseXOR(F.shiftright(folded, 8 * k).bitwiseAND(255))
    return signed_byte(lanes)


def byte_range(data: Column, offset: int, length: int) -> Column:
    """Bytes ``[offset, offset + length)`` of a binary value, clipped to its end
    (a read past the end contributes nothing, as zero bytes do to a XOR)."""
    return F.substring(data, offset + 1, length)


def xor_of_byte_range(data: Column, offset: int, length: int) -> Column:
    return xor_of_bytes(byte_range(data, offset, length))


def signed_byte(v: Column) -> Column:
    return F.when(v >= 128, v - 256).otherwise(v).cast("int")


def report_line(name: Column, count: Column, item: Column, value: Column) -> Column:
    return F.format_string(REPORT_FORMAT, name, count, item, value)
