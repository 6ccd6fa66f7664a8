from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings segments_merged audio_files speaker_roles role_aliases vocab pack_sizes rkka".split()
SOME = ["wn1_gap_detector", "wn2_drift_correction", "wn8_replica_islands", "jn1_dominant_overlap", "jn7_coverage_by_others", "ag5_replica_provenance", "prd1_journalist_phrase", "cl0_weighted_scores", "tx9_composite_clean", "voc5_reject_reason", "voc11_fuzzy_corrector", "jn11_snapshot_diff", "src6_txt_blocks", "ex2_split_by_words", "stream_sliding_windows"]


def value(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return tuple(value(x) for x in v.values()) if isinstance(v, dict) else v


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    r = con.execute(entry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = sorted(repr(tuple(value(x[names.index(c)]) for c in cols)) for x in r.fetchall())
    assert sorted(repr(tuple(value(x) for x in row)) for row in df.select(*cols).collect()) == want


def test_every_sql_has_its_query_and_entry_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
