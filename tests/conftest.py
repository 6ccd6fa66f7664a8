from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tapeloom.session import local_session  # noqa: E402

T = {"seg_id": pa.int64(), "file_id": pa.string(), "tape_no": pa.int32(), "start_us": pa.int64(), "end_us": pa.int64(), "time_hms": pa.string(), "speaker": pa.string(), "raw_speaker_id": pa.string(), "text": pa.string(), "confidence": pa.float64(), "from_gap": pa.bool_(), "sub_segments": pa.list_(pa.struct({"start_us": pa.int64(), "end_us": pa.int64(), "words": pa.int32()})), "auto_merged_from": pa.int32(), "loaded_at": pa.timestamp("us")}
SCHEMAS = {
    "segments_merged": T,
    "audio_files": {"file_id": pa.string(), "tape_no": pa.int32(), "filename": pa.string(), "surname": pa.string(), "given_name": pa.string(), "lang": pa.string(), "offset_us": pa.int64(), "duration_us": pa.int64(), "vad_threshold": pa.float64(), "pipeline_version": pa.string(), "recorded_at": pa.timestamp("us")},
    "speaker_roles": {"file_id": pa.string(), "tape_no": pa.int32(), "label": pa.string(), "role_name": pa.string()},
    "role_aliases": {"alias": pa.string(), "role_name": pa.string()},
    "rkka": {"page_id": pa.int64(), "url": pa.string(), "host": pa.string(), "html": pa.string(), "charset": pa.string(), "status_code": pa.int32(), "fetched_at": pa.timestamp("us")},
    "documents": {"doc_id": pa.int64(), "text": pa.string(), "lang": pa.string(), "source": pa.string(), "n_chars": pa.int64(), "doc_kind": pa.string(), "file_id": pa.string(), "added_at": pa.timestamp("us")},
    "vocab": {"term": pa.string(), "weight": pa.int32(), "category": pa.string()},
    "pack_sizes": {"pack_id": pa.int32(), "tokenizer": pa.string(), "capacity": pa.int32()},
}
DAY = dt.datetime(2024, 1, 1)


def write(folder: Path, table: str, rows: list[dict], extra: dict | None = None) -> None:
    schema = pa.schema([*SCHEMAS[table].items(), *[(k, pa.string()) for k in extra or {}]])
    pq.write_table(pa.Table.from_pylist([{**{c: None for c in schema.names}, **r, **(extra or {})} for r in rows], schema=schema), folder / f"{table}.parquet")


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", "tests", 4)
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture
def folder(tmp_path):
    """An empty sf folder; tests write the tables they need over the empty ones."""
    for t in SCHEMAS:
        write(tmp_path, t, [])
    return tmp_path


@pytest.fixture
def put():
    return write


@pytest.fixture
def seg():
    """A segment row; its delivery is the first unless said otherwise."""
    return lambda i, start, end, speaker="Журналист", **k: {"seg_id": i, "file_id": "f", "tape_no": 1, "start_us": start, "end_us": end, "speaker": speaker, "raw_speaker_id": "", "loaded_at": DAY, **k}
