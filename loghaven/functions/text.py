"""Field extraction from free-text log lines.

``regexp_extract`` yields ``''`` when nothing matches; every function here keeps
that, so a missing field of an access or syslog line is ``''``, not NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line formats.
FIRST_TOKEN = r"^(\S+)"
REQUEST_METHOD = r'"(GET|POST|PUT|DELETE|PATCH|OPTIONS|HEAD)\s'
REQUEST_PATH = r'"(?:GET|POST|PUT|DELETE|PATCH|OPTIONS|HEAD)\s+(\S+)'
RESPONSE_STATUS = r'"\s+(\d{3})\s+'
RESPONSE_BYTES = r'"\s+\d{3}\s+(\d+)'
SYSLOG_HOST = r"^\w{3}\s+\d+\s+\d+:\d+:\d+\s+(\S+)"
SYSLOG_PROGRAM = r"\s([A-Za-z0-9_.\-]+)(?:\[\d+\])?:"
WINDOWS_SOURCE = r"\s([A-Za-z0-9\-]+)(?:\[\d+\])?:"

# The program and source patterns match the first ``word:`` of a line, which on a line
# that opens with a time of day is its hour. These take the word after the host.
AFTER_HOST = r"^\w{3}\s+\d+\s+\d+:\d+:\d+\s+\S+"
SYSLOG_PROGRAM_AFTER_HOST = AFTER_HOST + SYSLOG_PROGRAM
WINDOWS_SOURCE_AFTER_HOST = AFTER_HOST + WINDOWS_SOURCE


def group1(line: Column, pattern: str) -> Column:
    return F.regexp_extract(line, pattern, 1)
