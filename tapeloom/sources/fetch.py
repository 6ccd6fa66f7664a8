"""Pages by address: the cache first, then a fetcher with retries, one host at a time per task."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "url string, html string, error string"


def fetch_missing(urls: DataFrame, cache: DataFrame, get: Callable[[str], str], tries: int = 3, wait_s: float = 1.0, pause_s: float = 1.0, days: int = 7) -> DataFrame:
    """(url) -> url, html, error: cached copies younger than ``days``; the rest through ``get``.

    Connection errors and timeouts are tried again with doubled waiting, other
    errors end as text in ``error``.  Addresses of a host come to one task, which
    keeps ``pause_s`` between two requests.
    """
    fresh = cache.filter(F.col("fetched_at") >= F.current_timestamp() - F.expr(f"interval {days} days")).groupBy("url").agg(F.max_by("html", "fetched_at").alias("html"))
    joined = urls.select("url").distinct().join(fresh, "url", "left")
    missing = joined.filter("html is null").select("url").repartition(F.regexp_extract("url", "^https?://([^/]*)", 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url in b["url"]:
                html, error, delay = None, None, wait_s
                for k in range(tries):
                    try:
                        html, error = get(url), None
                        break
                    except (ConnectionError, TimeoutError) as e:
                        error = str(e) or type(e).__name__
                        if k + 1 < tries:
                            time.sleep(delay)
                            delay *= 2
                    except Exception as e:  # noqa: BLE001 - one bad page must not end the rest
                        error = str(e) or type(e).__name__
                        break
                rows.append((url, html, error))
                time.sleep(pause_s)
            yield pd.DataFrame(rows, columns=["url", "html", "error"])

    return joined.filter("html is not null").select("url", "html", F.lit(None).cast("string").alias("error")).unionByName(missing.mapInPandas(run, SCHEMA))
