"""IPv4 arithmetic and address classes as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as private by the text of an address. The pattern ends after
# two digits, so 172.160.x to 172.255.x match as well; is_private_address has real ranges.
PRIVATE_TEXT = r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[0-1]))"
DOTTED_QUAD = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def is_private(ip: Column) -> Column:
    return ip.rlike(PRIVATE_TEXT)


def ipv4_number(ip: Column) -> Column:
    """Address as BIGINT; NULL when the text is not a dotted quad of 0..255."""
    octets = [
        F.try_element_at(F.split(ip, r"\."), F.lit(i + 1)).try_cast("bigint") for i in range(4)
    ]
    valid = ip.rlike(DOTTED_QUAD)
    for octet in octets:
        valid = valid & (octet <= 255)
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    return F.when(valid, number)


def is_private_address(ip: Column) -> Column:
    """Whether the number of an address lies in a private range; NULL for other text."""
    number = ipv4_number(ip)
    return (
        number.between(10 << 24, (11 << 24) - 1)
        | number.between((172 << 24) + (16 << 16), (172 << 24) + (32 << 16) - 1)
        | number.between((192 << 24) + (168 << 16), (192 << 24) + (169 << 16) - 1)
    )
