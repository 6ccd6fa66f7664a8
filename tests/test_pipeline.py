from __future__ import annotations

from tapeloom.plans import pipeline

S = 1_000_000


def test_from_deliveries_to_lines(spark, folder, put, seg):
    """Names, a command split off, a sentence carried, a duplicate dropped, drift, a merge, a repeated delivery: all in one transcript."""
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верестов", "given_name": "Ефим"}])
    put(folder, "speaker_roles", [{"file_id": "f", "tape_no": 1, "label": "SPEAKER_00", "role_name": "Верестов"}, {"file_id": "f", "tape_no": 1, "label": "SPEAKER_01", "role_name": "Журналист"}])
    said = lambda i, s, e, who, text, **k: seg(i, int(s * S), int(e * S), who, text=text, raw_speaker_id="SPEAKER_00" if who.startswith("в") else "SPEAKER_01", **k)
    rows = [
        said(1, 0, 4, "журн.", "Представьтесь."), said(2, 4.2, 9, "верестов", "Полк стоял у реки всю зиму."), said(3, 9.5, 12, "верест.", "Потом мы отошли."),
        said(4, 11, 14, "Ж.", "Полк стоял у реки всю зиму."), said(5, 30, 36, "Верестов", "Мы шли лесом к реке, переговорите еще раз про ту переправу"), said(6, 60, 61, "Верестов", "Untertitel von Test."), said(7, 62, 63, "Верестов", "  "), said(8, None or 70, 69, "Ж.", "обратно"),
    ]
    put(folder, "segments_merged", [*rows, rows[0], {**rows[1], "seg_id": 20, "file_id": None}])
    got = pipeline.lc0(spark, str(folder)).orderBy("pos").collect()
    lines = [r.line for r in got]
    assert lines[:2] == ["00:00:00 Журналист: Представьтесь.", "00:00:04 Верестов: Полк стоял у реки всю зиму. Потом мы отошли."]
    assert "00:00:30 Верестов: Мы шли лесом к реке," in lines and any(x.startswith("00:00:33 Журналист: переговорите еще раз про ту переправу") for x in lines)
    assert not any("Untertitel" in x for x in lines) and [r.pos for r in got] == list(range(1, len(got) + 1))
    put(folder, "segments_merged", [])
    assert pipeline.lc0(spark, str(folder)).count() == 0
