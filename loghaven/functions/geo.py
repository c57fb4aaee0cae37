"""Enrichment of an address from fixed prefix tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Whole first octets are internal; otherwise the first two
# characters of the text decide, so 172.16.0.1 reads as "United States" and
# 210.1.1.1 as "China". Use operators.netrange for real address ranges.
INTERNAL_OCTETS = ("192.", "10.")
PATTERN_OF_COUNTRY = {
    "United States": r"^1[7-8]",
    "Germany": r"^4[0-5]",
    "Russia": r"^9[0-5]",
    "China": r"^2[1-2]",
}
CITY_OF_COUNTRY = {
    "United States": "New York",
    "Germany": "Frankfurt",
    "Russia": "Moscow",
    "China": "Beijing",
}
TAG_OF_SUFFIX = {".100": "Known Malicious IP", ".200": "Tor Exit Node"}


def country_of(ip: Column) -> Column:
    internal = ip.startswith(INTERNAL_OCTETS[0])
    for octet in INTERNAL_OCTETS[1:]:
        internal = internal | ip.startswith(octet)
    out = F.when(internal, "Internal")
    for country, pattern in PATTERN_OF_COUNTRY.items():
        out = out.when(ip.rlike(pattern), country)
    return out.otherwise("Unknown")


def city_of(country: Column) -> Column:
    out = None
    for name, city in CITY_OF_COUNTRY.items():
        out = F.when(country == name, city) if out is None else out.when(country == name, city)
    return out.otherwise("Unknown")


def intelligence_tag(ip: Column) -> Column:
    out = None
    for suffix, tag in TAG_OF_SUFFIX.items():
        out = F.when(ip.endswith(suffix), tag) if out is None else out.when(ip.endswith(suffix), tag)
    return out.otherwise("Clean")
