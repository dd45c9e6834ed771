"""Column and table naming rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word-boundary patterns of the key-naming rule.
WORD_START = r"(.)([A-Z][a-z]+)"
CASE_CHANGE = r"([a-z0-9])([A-Z])"

# Fields that are kept in both stores.
LINK_FIELDS = ("username", "timestamp", "sys_ingested_at", "uuid")
COMMON_FIELDS = ("username", "timestamp", "sys_ingested_at")


def snake_case(name: Column) -> Column:
    """``userName`` -> ``user_name``, ``IPAddress`` -> ``ip_address``."""
    spaced = F.regexp_replace(name, WORD_START, "$1_$2")
    split = F.lower(F.regexp_replace(spaced, CASE_CHANGE, "$1_$2"))
    # Without a capital neither pattern matches, so most names skip the regular expressions.
    return F.when(F.lower(name) == name, name).otherwise(split)


def singular(name: Column) -> Column:
    """Drop every trailing ``s``: ``tags`` -> ``tag``, ``class`` -> ``cla``."""
    return F.regexp_replace(name, "s+$", "")
