from __future__ import annotations

import random

import pytest

from tapeloom.llm import turns
from tapeloom.llm.runs import p2_found, runs

S = 1_000_000


@pytest.mark.parametrize("chunk", [3, 30, 10_000])
def test_runs_against_brute_force(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(rnd.choice("fg"), rnd.choice("aab"), t := rnd.randrange(90), t + rnd.randrange(5), i) for i in range(160)] + [("f", None, 3, 4, 900), (None, "a", 3, 4, 901)]
    df = spark.createDataFrame(rows, "k string, v string, s long, e long, id long")
    want = set()
    for k in "fg":
        last = None
        for s, e, i, v in sorted((s, e, i, v) for x, v, s, e, i in rows if x == k and v):
            if last and last[1] == v:
                last[3] += 1
                last[5] = max(last[5], e)
            else:
                if last:
                    want.add(tuple(last))
                last = [k, v, i, 1, s, e]
        want.add(tuple(last))
    got = {tuple(r)[:6] for r in runs(df, "k", "v", ["s", "e", "id"], "s", "e", chunk).collect()}
    assert got == want


def test_p2_counts_differently_written_names_as_one(spark, folder, put, seg):
    put(folder, "segments_merged", [seg(1, 0, 1, "Журналист"), seg(2, 0, 1, "Ж."), seg(3, 5, 6, "Zhurnalist"), seg(4, 6, 7, "Оператор"), seg(5, None, 7, "Оператор")])
    assert [tuple(r) for r in p2_found(spark, str(folder)).collect()] == [("f", 1, 3)]
    put(folder, "segments_merged", [])
    assert p2_found(spark, str(folder)).count() == 0


CASES = [
    ("Это значит, что переправу готовили.", set()), ("Значит, свет, короче, поправьте.", {"filler"}), ("Как бы ни складывалась обстановка, рубеж держали.", set()), ("Как бы, полк отошёл.", {"filler"}),
    ("К 07:45 утра туман рассеялся.", set()), ("[00:01:02] Танки застряли.", {"timestamp"}), ("Танки (0:52) застряли.", {"timestamp"}), ("00:00:01,200 --> 00:00:04,000 Танки застряли.", {"timestamp"}), ("#00-03-43# Давайте вернёмся.", {"timestamp"}),
    ("Мосты [так в приказе] взорвали дважды.", set()), ("Сборный отряд (ЭМ и сторожевик) остался.", set()), ("[нрзб]", set()), ("Показали брод через [смех...] реку.", {"sound"}), ("♪ музыка ♪", {"sound", "no_speech"}), ("и только музыка доносилась через реку", set()),
    ("ЖУРНАЛИСТ: Когда это произошло?", {"head"}), (">> Верестов: Танки застряли.", {"head"}), ("[Верестов] Танки застряли.", {"head"}), ("Итог: потери тяжёлые.", set()), ("Следующий вопрос: чем кончился бой?", set()),
    ("Э-э... м-м-м", {"filler", "no_speech"}), ("...", {"no_speech"}), ("", {"no_speech"}), (None, {"no_speech"}), ("Der Brückenkopf wurde um 57 Kilometer erweitert.", set()), ("The um bridge had been mined.", {"filler"}),
]


def test_p4_kinds(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верестов", "given_name": "Ефим"}])
    put(folder, "segments_merged", [seg(i, i, i + 1, "Верестов", text=t) for i, (t, _) in enumerate(CASES)] + [seg(99, None, None, "верестов", text="Танки.")])
    got: dict[int, set] = {}
    for r in turns.p4_found(spark, str(folder)).collect():
        got.setdefault(r.seg_id, set()).add(r.kind)
    assert {i: (t, got.get(i, set())) for i, (t, _) in enumerate(CASES)} == dict(enumerate(CASES))
    assert got[99] == {"label"}


def test_turns_keep_only_what_is_said(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верестов", "given_name": "Ефим"}])
    put(folder, "segments_merged", [seg(1, 0, 1, "верест.", text="00:00:01 Верестов: Э-э, танки, значит, застряли [смех] у насыпи."), seg(2, 2, 3, "Ж.", text="Хм...")])
    got = turns.p4_turns(spark, str(folder)).collect()
    assert [(r.speaker, r.spoken) for r in got] == [("Верестов", "танки, застряли у насыпи.")]


def test_decoding_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    m = turns.Model.empty()
    for k in turns.TABLES:
        a = getattr(m, k)
        a[...] = rng.normal(size=a.shape)
    texts = [["Ну", "[", "смех", "]"], [], ["Танки", ",", "хм", ",", "застряли"]]
    x = turns.Seen(texts, [None, None, "Танки"], turns.Tokens())
    sizes, score = x.sizes, m.scores(x)
    got = m.decode(score, sizes)
    at = 0
    for n in sizes:
        if n:
            cost = lambda y: sum(score[at + i, y[i]] for i in range(n)) + sum(m.step[y[i - 1], y[i]] for i in range(1, n))  # noqa: B023, E731
            assert tuple(got[at : at + n]) == max(itertools.product(range(6), repeat=int(n)), key=cost)
        at += n


UNSEEN = [
    ("Разведка [хихикает] не нашла прохода.", {"sound"}), ("[сирена] Танки застряли.", {"sound"}), ("Полк вышел (выстрелы) к реке.", {"sound"}), ("The bridge [explosion] had been mined.", {"sound"}), ("Der Nachschub {Sirene} kam nur über das Eis.", {"sound"}),
    ("Танки, блин, застряли у самой насыпи.", {"filler"}), ("Связь, мгм, прервалась.", {"filler"}), ("Ээээээ, танки застряли.", {"filler"}), ("Er, ich glaube, war nicht bei der Brücke.", set()), ("Калибр трофейных орудий составлял 71 мм и больше.", set()), ("Полк, мм, вышел к реке.", {"filler"}),
    ("00:00:01 [тихий смех] [кашель] Верестов: Танки застряли.", {"timestamp", "sound", "head"}), ("[смех] [кашель] [стук] [шум] Верестов: Танки застряли.", {"sound", "head"}), ("Танки вёл Верестов: он знал брод.", set()), ("Мосты [так в приказе] взорвали; сборный отряд (ЭМ и сторожевик) остался.", set()), ("Полк " + "вышел к реке и " * 400 + "[смех] занял насыпь.", {"sound"}),
]


def test_p4_words_and_places_that_training_never_saw(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верестов", "given_name": "Ефим"}])
    put(folder, "segments_merged", [seg(i, i, i + 1, "Верестов", text=t) for i, (t, _) in enumerate(UNSEEN)])
    got: dict[int, set] = {}
    for r in turns.p4_found(spark, str(folder)).collect():
        got.setdefault(r.seg_id, set()).add(r.kind)
    assert {i: (t, got.get(i, set())) for i, (t, _) in enumerate(UNSEEN)} == dict(enumerate(UNSEEN))


def test_turns_are_assembled_in_order(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Верестов", "given_name": "Ефим"}])
    rows = [seg(3, 20 * S, 25 * S, "верест.", text="Мы вышли к реке."), seg(1, 0, 5 * S, "Ж.", text="Когда это произошло?"), seg(2, 5 * S, 9 * S, "Верестов", text="Утром."), seg(4, 12 * S, 13 * S, "Ж.", text="[смех]"), seg(5, 700 * S, 705 * S, "Верестов", text="Новая кассета."), seg(6, None, 9 * S, "Верестов", text="Без времени."), seg(7, 705 * S, 706 * S, "Ж.", text=None)]
    put(folder, "segments_merged", rows * 2)
    got = [tuple(r) for r in turns.p4_turns(spark, str(folder)).orderBy("turn").collect()]
    assert got == [("f", 1, "Журналист", 0, 5 * S, 1, 1, "Когда это произошло?"), ("f", 2, "Верестов", 5 * S, 25 * S, 2, 2, "Утром. Мы вышли к реке."), ("f", 3, "Верестов", 700 * S, 705 * S, 1, 5, "Новая кассета.")]
    put(folder, "segments_merged", [])
    assert turns.p4_turns(spark, str(folder)).count() == 0


@pytest.mark.parametrize("chunk", [1, 2, 7, None])
def test_runs_over_many_chunks_and_one_key(spark, chunk, monkeypatch):
    """One key holds all rows; runs span several chunks, batches and partitions; the prefix works in blocks of two chunks."""
    monkeypatch.setattr("tapeloom.operators.prefix.FAN", 2)
    rnd = random.Random(4)
    values = [v for v in rnd.choices("abc", k=60) for _ in range(rnd.choice([1, 1, 2, 9, 25]))]
    rows = [("k", v, i, i + 1, i) for i, v in enumerate(values)] + [("k", None, 3, 4, 900), ("k", "a", None, 4, 901)]
    df = spark.createDataFrame(rows, "k string, v string, s long, e long, id long").repartition(5)
    want, last = [], None
    for i, v in enumerate(values):
        if last and last[1] == v:
            last[3] += 1
            last[5] = i + 1
        else:
            last = ["k", v, i, 1, i, i + 1]
            want.append(last)
    got = sorted(tuple(r)[:6] for r in runs(df, "k", "v", ["s", "e", "id"], "s", "e", chunk).collect())
    assert got == sorted(map(tuple, want))
    assert runs(df.limit(0), "k", "v", ["s", "e", "id"], "s", "e", chunk).count() == 0


def test_one_recording_spreads_over_partitions(spark):
    import pyspark.sql.functions as F

    df = spark.range(200_000).select(F.lit("f").alias("k"), F.lit("x").alias("v"), F.col("id").alias("s"), F.col("id").alias("e"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = df.repartitionByRange("k", "s").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == 4 and max(r["count"] for r in parts) < 80_000
        assert [(r.n, r.s, r.e) for r in runs(df, "k", "v", ["s", "id"], "s", "e").collect()] == [(200_000, 0, 199_999)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
