from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import matching as M
from tapeloom.operators import folds
from tapeloom.operators.ordered import interval_join, with_islands, with_last, with_neighbours, with_running_sum
from tapeloom.operators.vocabulary import fuzzy_pairs
from tapeloom.plans import machines, more

S = 1_000_000


@pytest.mark.parametrize("chunk", [3, 40, 10_000])
def test_ordered_helpers_do_not_see_chunks(spark, chunk):
    rnd = random.Random(chunk)
    rows = [("a" if i % 3 else "b", rnd.randrange(100), i, rnd.choice([None, 1, 2])) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, t long, i long, v int")
    got = with_neighbours(df, "k", ["t", "i"], ["i", "v"], chunk=chunk)
    got = with_running_sum(got, "k", ["t", "i"], F.coalesce("v", F.lit(0)), "total", chunk)
    got = with_last(got, "k", ["t", "i"], F.col("v"), "last", chunk)
    got = {r.i: r for r in got.collect()}
    for k in "ab":
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))
        total, last = 0, None
        for j, (_, _, i, v) in enumerate(seq):
            total += v or 0
            before, after = seq[j - 1] if j else None, seq[j + 1] if j + 1 < len(seq) else None
            r = got[i]
            assert (r.prev_i, r.prev_v) == ((before[2], before[3]) if before else (None, None))
            assert (r.next_i, r.next_v) == ((after[2], after[3]) if after else (None, None))
            assert r.total == total and r["last"] == last
            last = v if v is not None else last


def test_islands_and_interval_join(spark):
    df = spark.createDataFrame([("f", t, t, w) for t, w in enumerate("aabbba")], "file_id string, start_us long, seg_id long, w string")
    got = with_islands(df, "file_id", ["start_us", "seg_id"], ["w"], F.coalesce(F.col("prev_w") != F.col("w"), F.lit(True)), chunk=2)
    assert [r.island for r in got.orderBy("start_us").collect()] == [1, 1, 2, 2, 2, 3]
    rnd = random.Random(1)
    a = [("f", i, s := rnd.randrange(300), s + rnd.randrange(0, 80)) for i in range(40)]
    b = [("f", i, s := rnd.randrange(300), s + rnd.randrange(0, 80)) for i in range(40)]
    left, right = spark.createDataFrame(a, "k string, x int, l_start long, l_end long"), spark.createDataFrame(b, "k string, y int, r_start long, r_end long")
    want = sorted((x, y) for _, x, s, e in a for _, y, p, q in b if p < e and s < q)
    assert sorted((r.x, r.y) for r in interval_join(left, right, "k", 20).collect()) == want


def row(i, start, end, text, speaker="Верест", raw="S1", gap=False):
    return {"file_id": "f", "seg_id": i, "start_us": int(start * S), "end_us": int(end * S), "text": text, "speaker": speaker, "raw_speaker_id": raw, "from_gap": gap}


def test_merge_joins_by_pause_and_drops_guarded_rows():
    got = folds.merge_run([row(1, 0, 2, "Полк стоял у реки."), row(2, 3, 4, "Потом отошёл."), row(3, 9, 8, "обратно"), row(4, 15, 16, "Утром вернулись.")])
    assert [(r["seg_id"], r["n"], r["text"]) for r in got] == [(1, 2, "Полк стоял у реки. Потом отошёл."), (4, 1, "Утром вернулись.")]


def test_merge_parts_journalist_labels_and_keeps_longer_of_equal_texts():
    got = folds.merge_run([row(1, 0, 2, "Вопрос первый", "Журналист", "A"), row(2, 3, 4, "Вопрос второй", "Журналист", "B")])
    assert len(got) == 2
    got = folds.merge_run([row(1, 0, 5, "танки вышли к селу"), row(2, 4, 6, "танки вышли к селу.")])
    assert [(r["text"], r["n"], r["sub_segments"][0]["end_us"]) for r in got] == [("танки вышли к селу.", 1, 6 * S)]


def test_merge_in_spark_parts_speakers(spark):
    rows = [row(1, 0, 1, "а б"), row(2, 1, 2, "в г"), row(3, 2, 3, "д е", "Журналист"), row(4, 3, 4, "ж з")]
    got = folds.merge_replicas(spark.createDataFrame(rows)).orderBy("start_us").collect()
    assert [(r.seg_id, r.n, len(r.sub_segments)) for r in got] == [(1, 2, 2), (3, 1, 1), (4, 1, 1)]


def test_texts():
    assert M.joined(["мы шли лесом", "шли лесом к реке"]) == "мы шли лесом к реке"
    assert M.trim_before("и тогда рота пошла", "рота пошла вперёд") == "и тогда"
    assert M.trim_after("рота пошла вперёд", "тогда рота пошла") == "вперёд"
    assert M.without_repeated_sentences("Полк отошёл. Полк отошёл. Всё.") == "Полк отошёл. Всё."
    assert M.without_loops("коротко") == "коротко"
    assert M.seam("один два три четыре пять шесть", "два три четыре пять шесть семь") >= 5
    assert M.similarity(None, "x") == 0.0
    assert M.corrupted("батарея держала дальний берег", ["батарея держала дальний берег"]) and not M.corrupted("да", ["нет"])


def test_timestamps_lie_inside_and_stop():
    text = " ".join(f"Предложение номер {i} сказано здесь." for i in range(40))
    got = M.with_timestamps(text, 0, 200 * S, [])
    marks = [int(w[:2]) * 3600 + int(w[3:5]) * 60 + int(w[6:]) for w in got.split() if w.count(":") == 2]
    assert len(marks) >= 5 and marks == sorted(marks) and all(0 < m < 200 for m in marks)
    assert M.with_timestamps(text, 0, 20 * S, []) == text
    assert M.with_timestamps(got, 0, 200 * S, []) == got


def test_near_duplicates_greedy(spark):
    rows = [row(1, 0, 2, "танки вышли к дальнему селу утром", "A"), row(2, 1, 3, "танки вышли к дальнему селу утром", "B"), row(3, 2, 4, "совсем иное слово", "A")]
    got = folds.near_duplicates(spark.createDataFrame(rows), across=True).collect()
    assert [(r.removed, r.kept) for r in got] == [(2, 1)]
    assert folds.near_duplicates(spark.createDataFrame(rows).limit(0), across=False).count() == 0


def test_bilingual_alignment():
    rows = [{"part": "1-1", "sec": s, "side": k} for k, s in ((0, 0), (0, 20), (0, 50), (1, 0), (1, 24), (1, 90))]
    assert {(r["de_sec"], r["ru_sec"]) for r in folds.align_section(rows)} == {(0, 0), (20, 24), (50, None), (None, 90)}


def test_fuzzy_pairs_against_all_pairs(spark):
    words = ["abcd", "abcde", "abdc", "xbcd", "aacd", "zzzz", "abcdef", "bcd"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    want = {(a, b) for a in words for b in words if distance(a, b) <= 2}
    assert {(r.w, r.v) for r in fuzzy_pairs(df, df.withColumnRenamed("w", "v")).collect()} == want


def distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_jn3_takes_the_roles_of_each_tape(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": t, "surname": "Верест"} for t in (1, 2)])
    put(folder, "speaker_roles", [{"file_id": "f", "tape_no": t, "label": k, "role_name": v} for t, k, v in ((1, "S0", "Верест"), (1, "S1", "Журналист"), (2, "S0", "Журналист"), (2, "S1", "Верест"), (2, "S2", "Оператор"))])
    said = lambda i, tape, raw: seg(i, 10 * i * S, (10 * i + 9) * S, raw_speaker_id=raw, tape_no=tape, text="полк стоял")
    put(folder, "segments_merged", [said(1, 1, "S0"), said(2, 1, "S1"), said(3, 2, "S1"), said(4, 2, "S0"), said(5, 2, "S2")])
    got = {r.seg_id: r.speaker for r in machines.jn3(spark, str(folder)).collect()}
    assert got == {1: "Верест", 2: "Журналист", 3: "Верест", 4: "Журналист", 5: "Оператор"}


@pytest.mark.parametrize("query", [more.dd3, machines.jn8, machines.cl1])
def test_groups_change_nothing(spark, folder, put, seg, monkeypatch, query):
    rnd = random.Random(7)
    words = ["дальше рота шла лесом к реке", "потом мы снова пошли к реке", "расскажите почему полк стоял там", "да"]
    rows, at = [], 0
    for i in range(400):
        at += rnd.choice([0, 1, 3, 9, 70])
        rows.append(seg(i, at * S, (at + rnd.choice([1, 2, 8, 40])) * S, rnd.choice(["Верест", "Журналист"]), text=f"{rnd.choice(words)} {i}", from_gap=i % 3 > 0))
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верест"}])
    put(folder, "segments_merged", rows)
    got = sorted(map(tuple, query(spark, str(folder)).collect()))
    whole = folds.fold
    monkeypatch.setattr(folds, "fold", lambda df, keys, *rest: whole(df, ["file_id"], *rest))
    assert got == sorted(map(tuple, query(spark, str(folder)).collect()))


def test_nested_overlap_and_memory_over_a_long_pause(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верест"}])
    put(folder, "segments_merged", [seg(1, 0, 100 * S, "Верест", text="полк стоял у реки всю зиму"), seg(2, 10 * S, 20 * S, "Верест", text="полк стоял у реки всю зиму"), seg(3, 30 * S, 90 * S, "Верест", text="полк стоял у реки всю зиму"), seg(4, 200 * S, 210 * S, "Журналист", text="то есть полк пошёл вперёд к реке")])
    assert [r.seg_id for r in more.dd3(spark, str(folder)).orderBy("start_us").collect()] == [1, 4]
    assert {r.seg_id: r.speaker for r in machines.cl1(spark, str(folder)).collect()}[4] == "Верест"


def test_near_duplicate_that_others_hide_goes(spark):
    said = "танки вышли к дальнему селу утром"
    rows = [row(1, 0, 4, said, "A"), row(2, 0, 3.5, "иное", "A"), row(3, 3.9, 8, said, "B")]
    got = folds.near_duplicates(spark.createDataFrame(rows), across=True).collect()
    assert [(r.removed, r.kept) for r in got] == [(1, 3)]
