"""Per-device topics and topic filters with ``+`` and ``#`` wildcards."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def device_topic(prefix: str, device: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix), device)


def topic_pattern(topic_filter: str) -> str:
    """Regular expression of a subscription filter.

    ``+`` stands for one level; a final ``#`` for the level above it and everything below.
    """
    levels = topic_filter.split("/")
    if any("#" in level for level in levels[:-1]) or any(
        len(level) > 1 and ("+" in level or "#" in level) for level in levels
    ):
        raise ValueError(f"wildcards must fill a level and # must be last: {topic_filter!r}")
    body = ["[^/]*" if level == "+" else re.escape(level) for level in levels]
    if levels[-1] != "#":
        return "^" + "/".join(body) + "$"
    if len(levels) == 1:
        return "^.*$"
    return "^" + "/".join(body[:-1]) + "(/.*)?$"


def topic_matches(topic: Column, topic_filter: str) -> Column:
    return topic.rlike(topic_pattern(topic_filter))
