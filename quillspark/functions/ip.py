"""IPv4 addresses and CIDR blocks as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The same rule as SQL text, for the registered function: NULL unless four octets in 0..255.
_OCTETS = [f"try_cast(get(split(ip, '[.]', -1), {i}) AS BIGINT)" for i in range(4)]
IP_TO_LONG_SQL = ("CASE WHEN size(split(ip, '[.]', -1)) = 4 AND "
                  + " AND ".join(f"{o} BETWEEN 0 AND 255" for o in _OCTETS) + " THEN "
                  + " + ".join(f"{o} * {1 << (24 - 8 * i)}" for i, o in enumerate(_OCTETS)) + " END")


def ip_to_long(ip) -> Column:
    """Dotted quad to its 32-bit value (bigint); NULL unless four octets in 0..255."""
    parts = F.split(_c(ip), "[.]", -1)
    octs = [F.get(parts, i).try_cast("bigint") for i in range(4)]
    value = octs[0] * 16777216 + octs[1] * 65536 + octs[2] * 256 + octs[3]
    ok = (F.size(parts) == 4)
    for o in octs:
        ok = ok & o.between(0, 255)
    return F.when(ok, value)


def cidr_prefix(network) -> Column:
    """Prefix length; a network without one is a single address (32)."""
    n = _c(network)
    return F.when(n.contains("/"), F.substring_index(n, "/", -1)).otherwise("32").try_cast("int")


def cidr_start(network) -> Column:
    """First address of the block (host bits cleared)."""
    base = ip_to_long(F.substring_index(_c(network), "/", 1))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), 32 - cidr_prefix(network))
    return base - F.pmod(base, size)


def cidr_end(network) -> Column:
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), 32 - cidr_prefix(network))
    return cidr_start(network) + size - 1


def cidr_bounds(network) -> list[Column]:
    return [cidr_start(network).alias("start"), cidr_end(network).alias("end"),
            cidr_prefix(network).alias("prefix")]
