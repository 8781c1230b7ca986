"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_prefix(digest: Column, start: int, digits: int) -> Column:
    """``digits`` hex digits of a digest, from 1-based ``start``, as a number."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def object_id(digest: Column) -> Column:
    """A 16-digit hex digest as a 64-bit key; hex case does not matter."""
    return F.conv(digest, 16, -10).cast("bigint")


def object_hex(obj: Column) -> Column:
    return F.lpad(F.hex(obj), 16, "0")


def is_digest(digest: Column) -> Column:
    return (F.length(digest) == 16) & F.unhex(digest).isNotNull()


def object_draw(obj: Column, seq: Column) -> Column:
    """Reproducible draw for one request of an object: 28 bits of md5(object:seq)."""
    return hex_prefix(F.md5(F.concat_ws(":", object_hex(obj), seq)), 1, 7)


def sample_hash(digest: Column) -> Column:
    """Sampling hash of a digest; uses other digits than the url routing does."""
    return hex_prefix(digest, 9, 8)


def pack_ip(ip: Column) -> Column:
    """Dotted quad packed into a signed 32-bit int; null unless there are four octets."""
    octets = F.split(ip, r"\.")

    def octet(i: int) -> Column:
        return F.get(octets, F.lit(i)).try_cast("int")

    packed = (F.shiftleft(octet(0), 24).bitwiseOR(F.shiftleft(octet(1), 16))
              .bitwiseOR(F.shiftleft(octet(2), 8)).bitwiseOR(octet(3)))
    return F.when(F.size(octets) == 4, packed)


def has_flag(status: Column, letter: str) -> Column:
    return F.instr(F.coalesce(status, F.lit("")), letter) > 0


def is_miss(status: Column) -> Column:
    return has_flag(status, "o") | has_flag(status, "p")


def inflated(bytes_: Column, size: Column) -> Column:
    return F.greatest(bytes_, size)


def shortfall(size: Column, bytes_: Column) -> Column:
    """Bytes of the object that were not sent, never negative."""
    return F.greatest(size - bytes_, F.lit(0).cast("bigint"))


def numeric_map_id(name: Column) -> Column:
    """The map id when the whole name is a positive integer, else null."""
    number = F.when(name.rlike("^[0-9]+$"), name.try_cast("int"))
    return F.when(number > 0, number)


def record_tail() -> Column:
    """The routed record text after its shard and timestamp: the order of requests
    that share both."""
    return F.concat_ws(":", "md5", "size", "bytes", "cpcode", "true_serial", "max_age")


def record_text() -> Column:
    """Canonical routed record ``shard:ts:md5:size:bytes:cpcode:serial:max_age``."""
    return F.concat_ws(":", "shard", F.format_string("%.3f", "ts"), record_tail())
