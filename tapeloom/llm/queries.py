"""Queries of the llm problems and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import bpe, dom, garble, packing, residue, runs, turns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": runs.p2_found,
    "p2_runs": runs.p2_runs,
    "p2_label_runs": runs.p2_label_runs,
    "p3_found": garble.p3_found,
    "p3_repaired": garble.p3_repaired,
    "p4_found": turns.p4_found,
    "p4_turns": turns.p4_turns,
    "p5_found": dom.p5_found,
    "p5_bodies": dom.p5_bodies,
    "p6_ids": bpe.p6_ids,
    "p6_round_trip": bpe.p6_round_trip,
    "p7_packed": packing.p7_packed,
    "p7_fill": packing.p7_fill,
    "p7_parts": packing.p7_parts,
    "p8_found": residue.p8_found,
    "p8_reasons": residue.p8_reasons,
    "p8_kept": residue.p8_kept,
}

#: The parts of the problems that SQL can say; the rest is held by brute force, round trips and held-out labels in tests.
SQL: dict[str, str] = runs.SQL | packing.SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
