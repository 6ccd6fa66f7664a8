"""How often terms stand in texts, as substrings: one pass over the texts for a whole dictionary.

Every text is run once through an automaton of all terms; the hits of one term
that overlap count once, from the left.  A dictionary is taken in blocks of
BLOCK terms, one pass each, so its automaton always fits a worker.

Defined results: case does not count; null and blank terms and null texts count
nothing; a term that stands twice in the dictionary counts once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms of one automaton, and counts that a partition holds before it gives them out.
BLOCK = 200_000


def _automaton(terms: list[str]):  # noqa: ANN202
    import ahocorasick

    out = ahocorasick.Automaton()
    for t in terms:
        out.add_word(t, t)
    out.make_automaton()
    return out


def counts_in(texts: DataFrame, column: str, terms: list[str]) -> DataFrame:
    """(low, n) of the terms, in lower case, that stand in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, n = _automaton(terms), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                free: dict[str, int] = {}
                for end, t in find.iter(text.lower()):
                    if end - len(t) + 1 >= free.get(t, 0):
                        free[t] = end + 1
                        n[t] += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["low", "n"])

    return texts.filter(F.col(column).isNotNull()).select(column).mapInArrow(run, "low string, n bigint").groupBy("low").agg(F.sum("n").alias("n"))


def term_counts(texts: DataFrame, column: str, dictionary: DataFrame, term: str = "term") -> DataFrame:
    """(low, n): occurrences of every term of the dictionary that occurs."""
    words = dictionary.select(F.lower(term).alias("low")).filter("trim(low) <> ''").distinct()
    block: list[str] = []
    parts: list[DataFrame] = []
    for r in words.toLocalIterator():
        block.append(r.low)
        if len(block) == BLOCK:
            parts.append(counts_in(texts, column, block))
            block = []
    parts.append(counts_in(texts, column, block) if block else texts.sparkSession.createDataFrame([], "low string, n bigint"))
    return reduce(DataFrame.unionByName, parts)
