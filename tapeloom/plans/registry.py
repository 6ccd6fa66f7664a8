"""All core queries and their SQL, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeloom.operators import speech_periods
from tapeloom.plans import intervals, machines, more, pipeline, texts, vocabulary
from tapeloom.streaming import windows

FLAGSHIP = "wn8_replica_islands"

_MODULES: list = [intervals, texts, vocabulary, machines, more, pipeline, windows]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p1_found": speech_periods.p1_found, "p1_periods": speech_periods.p1_periods, "p1_label_periods": speech_periods.p1_label_periods}
    for m in _MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = dict(speech_periods.SQL)
    for m in _MODULES:
        out |= m.SQL
    return out
