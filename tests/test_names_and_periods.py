from __future__ import annotations

import datetime as dt
import random

import pytest

from tapeloom.operators.intervals import gaps, periods
from tapeloom.operators.speech_periods import p1_found, timed_and_named

S = 1_000_000
ALIASES = [{"alias": a, "role_name": r} for a, r in (("Корреспондент", "Журналист"), ("Interviewer", "Журналист"), ("Kamera", "Оператор"), ("Эксперт", "Спикер"), ("Guest", "Спикер"))]


def tape(folder, put, surname="Верестачёв", given="Ефим"):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": surname, "given_name": given}])
    put(folder, "speaker_roles", [{"file_id": "f", "tape_no": 1, "label": "SPEAKER_00", "role_name": "Журналист"}, {"file_id": "f", "tape_no": 1, "label": "SPEAKER_01", "role_name": surname}])
    put(folder, "role_aliases", ALIASES)


NAMES = [
    ("Верестачёв", None, "Верестачёв"), ("  верестачев ", None, "Верестачёв"), ("[ВЕРЕСТАЧЁВ]", None, "Верестачёв"), ("Е. Верестачёв", None, "Верестачёв"), ("Верестачёв, Ефим", None, "Верестачёв"), ("подполковник Верестачёв", None, "Верестачёв"),
    ("Верест.", None, "Верестачёв"), ("Вepecтaчёв", None, "Верестачёв"), ("Верстачёв", None, "Верестачёв"), ("Веретсачёв", None, "Верестачёв"), ("Verestachyov", None, "Верестачёв"), ("Эксперт", "SPEAKER_00", "Верестачёв"), ("guest:", None, "Верестачёв"),
    ("Журналист -", None, "Журналист"), ("Жypнaлиcт", None, "Журналист"), ("Журанлист", None, "Журналист"), ("Ж.", None, "Журналист"), ("Жур-т", None, "Журналист"), ("Корр.", None, "Журналист"), ("журналистка", None, "Журналист"), ("Zhurnalist", None, "Журналист"), ("interviewer:", None, "Журналист"),
    ("Опер.", None, "Оператор"), ("оператор-постановщик", None, "Оператор"), ("KAMERA", None, "Оператор"), ("Оепратор", None, "Оператор"),
    ("Speaker 01", "SPEAKER_00", "Верестачёв"), ("SPK_00", None, "Журналист"), ("speaker_7", None, "Неизвестно"), (None, "SPEAKER_01", "Верестачёв"), ("—", "spk 0", "Журналист"), ("?", "GAP_FILLED", "Неизвестно"), ("", "", "Неизвестно"), (" ", None, "Неизвестно"),
    ("неизв.", "SPEAKER_01", "Неизвестно"), ("UNKNOWN", "SPEAKER_01", "Неизвестно"), ("Иванопуло", "SPEAKER_01", "Неизвестно"),
]


def test_names_in_any_writing(spark, folder, put, seg):
    tape(folder, put)
    put(folder, "segments_merged", [seg(i, i * S, i * S + 1, s, raw_speaker_id=r) for i, (s, r, _) in enumerate(NAMES)], {"name": "x", "surname": "y", "_t": "z"})
    got = {r.seg_id: r.name for r in timed_and_named(spark, str(folder)).collect()}
    assert {i: (s, r, got[i]) for i, (s, r, _) in enumerate(NAMES)} == {i: x for i, x in enumerate(NAMES)}


def test_unknown_tape_resolves_roles_only(spark, folder, put, seg):
    put(folder, "role_aliases", ALIASES)
    put(folder, "segments_merged", [seg(1, 0, 1, "журналист"), seg(2, 0, 1, "Верестачёв"), seg(3, 0, 1, "Эксперт")])
    assert {r.seg_id: r.name for r in timed_and_named(spark, str(folder)).collect()} == {1: "Журналист", 2: "Неизвестно", 3: "Неизвестно"}


def test_periods_and_gaps_of_a_recording(spark, folder, put, seg):
    tape(folder, put)
    late = dt.datetime(2025, 1, 1)
    rows = [
        seg(1, 0, 2 * S), seg(2, 2 * S, 3 * S, "Ж."), seg(3, 1 * S, int(1.5 * S), "журналист"),  # touch and nest
        seg(4, 10 * S, 11 * S, "Верестачёв"), seg(5, 700 * S, 701 * S), seg(6, 1302 * S, 1303 * S),  # 7 s and 599 s are gaps, 601 s is not
        seg(7, 1400 * S, 1390 * S), seg(8, None, 5 * S), seg(9, 1310 * S, 1311 * S), seg(9, 1306 * S, 1307 * S, loaded_at=late), seg(9, 1306 * S, 1307 * S, loaded_at=late),
    ]
    put(folder, "segments_merged", [r if r["seg_id"] != 5 else {**r, "start_us": 610 * S, "end_us": 611 * S} for r in rows])
    got = {tuple(r) for r in p1_found(spark, str(folder)).collect()}
    assert got == {("period", "f", "Журналист", 0, 3 * S), ("gap", "f", "*", 3 * S, 10 * S), ("gap", "f", "*", 11 * S, 610 * S)}


def test_empty_tables(spark, folder):
    assert p1_found(spark, str(folder)).count() == 0


@pytest.mark.parametrize("chunk", [7, 50, 10_000])
def test_periods_and_gaps_against_brute_force(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(rnd.choice("ab"), s := rnd.randrange(0, 600), s + rnd.choice([0, 0, 1, 3, 9, 90])) for _ in range(250)] + [("a", None, 3), (None, 1, 2), ("b", 9, 2)]
    df = spark.createDataFrame(rows, "k string, start_us long, end_us long")
    want, holes = set(), set()
    for k in "ab":
        cur = None
        for s, e in sorted((s, e) for x, s, e in rows if x == k and s is not None and e >= s):
            if cur and s <= cur[1]:
                cur = [cur[0], max(cur[1], e), cur[2] + 1]
            else:
                if cur:
                    want.add((k, *cur))
                    holes.add((k, cur[1], s))
                cur = [s, e, 1]
        want.add((k, *cur))
    assert {tuple(r) for r in periods(df, ["k"], chunk_us=chunk).collect()} == want
    assert {tuple(r) for r in gaps(df, ["k"], longer_than_us=0, chunk_us=chunk).collect()} == holes


def test_a_long_alias_table_gives_the_same_names(spark, folder, put, seg, monkeypatch):
    from tapeloom.operators import names

    tape(folder, put)
    put(folder, "segments_merged", [seg(i, i * S, i * S + 1, s, raw_speaker_id=r) for i, (s, r, _) in enumerate(NAMES)])
    monkeypatch.setattr(names, "MAX_ALIASES", 2)
    got = {r.seg_id: r.name for r in timed_and_named(spark, str(folder)).collect()}
    assert got == {i: n for i, (_, _, n) in enumerate(NAMES)}
