"""Fixtures of the merge family: guards, loops, sentences carried over, duplicates of one speaker, replicas of two speakers."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tapeloom.functions import matching as M
from tapeloom.operators import folds
from tapeloom.plans import intervals, machines

S = 1_000_000
WHO = "Верестов"


def row(i, start, end, text, speaker=WHO, raw="S0", gap=False, surname=WHO):
    return {"file_id": "f", "seg_id": i, "start_us": int(start * S), "end_us": int(end * S), "speaker": speaker, "raw_speaker_id": raw, "text": text, "from_gap": gap, "surname": surname}


ARTILLERY = [
    (1289.92, 1292.08, "И еще одним фактором,"), (1292.22, 1294.30, "который необходимо учитывать,"), (1294.30, 1299.28, "была немецкая артиллерия вправь до еще одним фактором которые надо учитывать это было немецкая", True), (1299.28, 1296.74, "вплоть до..."),
    (1298.12, 1299.16, "который надо учитывать,"), (1299.28, 1301.18, "это была немецкая артиллерия,"), (1301.38, 1302.92, "вплоть до самых крупных калибров."), (1303.24, 1304.50, "Самый большой калибр,"),
]
PATROLS = [
    (2093.42, 2093.88, "например,"), (2094.08, 2094.66, "такой мерой"), (2094.66, 2095.00, "были"), (2095.00, 2096.48, "офицерские,"), (2096.66, 2097.58, "командирские"), (2097.58, 2105.58, "патрули, когда прибывающая артиллерия распределялась не просто регулировщиками, а специальными офицерскими", True),
    (2105.58, 2098.56, "когда"), (2098.56, 2099.42, "прибывающая"), (2099.42, 2100.10, "артиллерия,"), (2100.10, 2101.46, "она распределялась"), (2101.46, 2102.12, "не просто"), (2102.12, 2103.64, "регулировщиками,"), (2103.80, 2104.90, "а специальными"), (2104.90, 2105.58, "офицерскими"),
    (2105.58, 2106.20, "патрулями,"), (2106.36, 2107.46, "что способствовало"), (2107.46, 2109.80, "упорядочиванию"), (2109.80, 2110.56, "движения"),
]


@pytest.mark.parametrize(("said", "kept", "gone"), [
    (ARTILLERY, ["И еще одним фактором", "который необходимо учитывать", "немецкая артиллерия", "вплоть до самых крупных калибров"], ["вправь до", "надо учитывать это было"]),
    (PATROLS, ["например", "такой мерой", "были", "офицерские", "командирские", "патрулями", "что способствовало", "упорядочиванию"], ["специальными офицерскими когда"]),
])
def test_guards_of_filled_gaps(spark, said, kept, gone):
    rows = [row(i, s, e, t, gap=bool(g)) for i, (s, e, t, *g) in enumerate(said)]
    got = folds.merge_replicas(spark.createDataFrame(rows)).orderBy("start_us").collect()
    assert all(x in got[0].text for x in kept) and not any(x in got[0].text for x in gone)
    # rows that guards dropped are no members, and a row is given out once
    assert all(r.n == len(r.sub_segments) for r in got) and sum(r.n for r in got) <= len(rows)


def test_guard_looks_across_seams_of_the_last_five_texts():
    assert M.corrupted("батарея держала дальний берег", ["наша батарея держала", "дальний берег реки"])
    assert not M.corrupted("батарея держала дальний берег", ["наша батарея держала", *["полк шёл лесом"] * 5])
    assert not M.corrupted("был была были будет", ["был была были будет"]) and not M.corrupted("", [])


@pytest.mark.parametrize(("text", "kept"), [
    ("немецкая артиллерия могла бить вправь и влево вдоль берега. Там было. и, в общем-то, немецкая артиллерия не была так далеко. Жуков не был. И вот немцы", "Жуков не был."),
    ("это очень важный момент это очень важный момент это очень важный момент в истории войны", "это очень важный момент"),
    ("это было принято решением ставки. И вот было, что называется, сделано всё возможное. Результат был. И вот немцы отступили.", "Результат был."),
    ("и вот и вот и вот продолжали наступление. Немецкая артиллерия была сосредоточена.", "продолжали наступление"),
    ("прорыв блокады был осуществлён в январе 1943 года. Войска двух фронтов соединились.", "прорыв блокады был осуществлён в январе 1943 года. Войска двух фронтов соединились."),
    ("основу обороны составляли стрелковые части, которые держали фронт. основу обороны составляли стрелковые части, которым не хватало боеприпасов.", "которым не хватало"),
    ("фронта на прорыв блокады изнутри. Надеждой на прорыва блокада изнутри был Говоров.", "прорыв блокады"),
    ("Поэтому план Искры, отцом которого, безусловно, был прежде всего Говоров, была основа плана Искры, отцом которой был, безусловно, Говоров, было то, что весь опыт был проанализирован", "плана Искры"),
])
def test_loops(text, kept):
    assert kept in M.without_loops(text)


def test_a_plain_loop_gets_shorter_and_short_words_pass():
    text = "танки вышли утром танки вышли утром танки вышли утром к реке"
    assert M.without_loops(text).split().count("танки") < 3
    assert M.without_loops("и вот и вот и вот и вот") == "и вот и вот и вот и вот" and M.without_loops("") == ""
    assert M.without_loops("так!!!! и было") == "так! и было"


def test_sentences_said_twice_are_used_up_in_pairs():
    assert M.without_repeated_sentences("Полк отошёл. Полк отошёл. Полк отошёл.") == "Полк отошёл. Полк отошёл."
    assert M.without_repeated_sentences("Мы ничего не знали. Ничего не знали. Шли.") == "Мы ничего не знали. Шли."
    assert M.cleaned("Untertitel von Test. Полк отошёл. Полк отошёл. Спасибо за внимание!") == "Полк отошёл."
    assert M.cleaned("  ") == "  " and M.cleaned("Так...  и   было!!") == "Так. и было!"


def test_a_nearly_equal_overlapping_row_takes_the_place_of_the_last_member():
    longer = folds.merge_run([row(1, 0, 5, "танки вышли к селу"), row(2, 4, 6, "танки вышли к селу утром")])
    assert [(r["text"], r["n"], r["end_us"], r["sub_segments"][0]["start_us"]) for r in longer] == [("танки вышли к селу утром", 1, 6 * S, 4 * S)]
    shorter = folds.merge_run([row(1, 0, 5, "танки вышли к селу утром"), row(2, 4, 6, "танки вышли к селу")])
    assert [(r["text"], r["n"], r["end_us"], r["sub_segments"][0]["start_us"]) for r in shorter] == [("танки вышли к селу утром", 1, 6 * S, 0)]


def test_groups_of_the_merge_change_nothing(spark, monkeypatch):
    import random

    rnd, rows, at = random.Random(3), [], 0.0
    for i in range(300):
        at += rnd.choice([0, 0.5, 1, 3, 4.5, 7])
        rows.append(row(i, at, at + rnd.choice([-1, 0.5, 2, 30]), rnd.choice(["полк стоял у реки", "рота шла лесом", "рота шла лесом дальше", "да"]), rnd.choice([WHO, WHO, "Журналист"]), rnd.choice(["S0", "S1", ""]), rnd.random() < 0.2))
    df = spark.createDataFrame(rows)
    got = sorted(map(repr, folds.merge_replicas(df).collect()))
    runs, out = [], []
    for r in sorted(rows, key=lambda r: (r["start_us"], r["seg_id"])):
        if not runs or runs[-1][-1]["speaker"] != r["speaker"]:
            runs.append([])
        runs[-1].append(r)
    for run in runs:
        out += folds.merge_run(run)
    assert [(r["seg_id"], r["text"], r["n"]) for r in out] == sorted(((r.seg_id, r.text, r.n) for r in folds.merge_replicas(df).collect()), key=lambda x: next(i for i, y in enumerate(out) if y["seg_id"] == x[0]))
    assert len(got) == len(out)


def test_last_sentence_goes_over_to_the_next_speaker(spark):
    a, b, c = "Полк стоял. Когда пришли танки", "Утром.", "Мы ждали."
    rows = [row(1, 0, 5, a), row(2, 5.2, 6, b, "Журналист"), row(3, 9, 10, "Было так. Я считаю иначе"), row(4, 10.1, 12, c, "Журналист"), row(5, 12.2, 13, "Вопрос. Расскажите о полке", "Журналист"), row(6, 13.3, 14, "Да."), row(7, 14.2, 15, None, "Журналист")]
    got = {r.seg_id: r.text for r in folds.boundary_carry(spark.createDataFrame(rows)).collect()}
    assert got == {1: "Полк стоял.", 2: "Когда пришли танки Утром.", 3: "Было так. Я считаю иначе", 4: c, 5: "Вопрос. Расскажите о полке", 6: "Да.", 7: ""}


def test_duplicates_of_one_speaker_are_stars(spark):
    same = "рота перешла реку по льду ночью"
    rows = [row(1, 0, 5, same), row(2, 6, 9, same + " и утром"), row(3, 10, 14, same), row(4, 20, 22, "совсем другое слово")]
    got = sorted((r.removed, r.kept) for r in folds.near_duplicates(spark.createDataFrame(rows), across=False).collect())
    assert got == [(1, 2), (3, 2)]
    # the overlap is a share of the current row: here row 1 lies wholly in row 2, not the other way round
    near = [row(1, 0, 2, "рота перешла реку по льду ночью"), row(2, 0, 40, "рота перешла речку по мосту днём")]
    ratio = M.similarity(near[0]["text"], near[1]["text"])
    assert 0.70 < ratio <= 0.85
    assert [(r.removed, r.kept) for r in folds.near_duplicates(spark.createDataFrame(near), across=False).collect()] == [(1, 2)]
    turned = [row(1, 0, 40, near[1]["text"]), row(2, 0, 2, near[0]["text"])]
    assert folds.near_duplicates(spark.createDataFrame(turned), across=False).count() == 0


MIXED = "Ну, вы ответили практически на этот вопрос. Да, ну давайте еще раз. Нет, не надо еще раз, может, что-то добавить. Да, давай. Почему Говоров настаивал на проведении операции именно зимой."


def test_replicas_of_two_speakers():
    parts = M.split_speakers("Полк стоял у реки. Расскажите о переправе. То есть о мосте. Мы шли лесом.", WHO, WHO, 0, 130 * S)
    assert [(p[0], p[1]) for p in parts] == [(WHO, "Полк стоял у реки."), ("Журналист", "Расскажите о переправе. То есть о мосте."), (WHO, "Мы шли лесом..")]
    assert parts[0][2] == 0 and parts[-1][3] == 130 * S and all(a[3] == b[2] for a, b in zip(parts, parts[1:], strict=False)) and parts[0][3] == 130 * S * 4 // 14
    # a first sentence that differs opens no part before it; neutral words are the replica's speaker's
    assert {p[0] for p in M.split_speakers(MIXED, "Журналист", WHO, 861_400_000, 871_460_000)} == {"Журналист"}
    assert M.split_speakers("Следующий вопрос про мост. Да.", WHO, WHO, 0, S) == [(WHO, "Следующий вопрос про мост. Да.", 0, S)]
    assert M.split_speakers("", WHO, None, 0, S) == [(WHO, "", 0, S)]
    # weak marks do not count after a hundred words of one part
    long = "Мы шли лесом " * 40 + "к реке. Давайте дальше."
    assert len(M.split_speakers(long, WHO, WHO, 0, S)) == 1 and len(M.split_speakers("Мы шли. Давайте дальше.", WHO, WHO, 0, S)) == 2


def both(spark, folder, name):
    got = entry.queries()[name](spark, str(folder))
    con = duckdb.connect()
    for t in ("segments_merged", "audio_files", "speaker_roles"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    r = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted(map(repr, (tuple(x) for x in got.select(*names).collect())))
    assert rows == sorted(map(repr, r.fetchall()))
    return [x.asDict() for x in got.collect()]


def test_command_halves_equal_their_sql(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": WHO}])
    said = ["Полк шёл лесом к реке, переговорите еще раз про ту переправу", "Повторите полк шёл лесом к реке", "Рота три дня шла лесом не переговорите это место снова потом", "Мы начинали с начала той самой зимы и потом снова заново шли", "слово", None]
    put(folder, "segments_merged", [seg(i, i * 10, i * 10 + 7, WHO, text=t) for i, t in enumerate(said)] + [seg(90, 0, 9, "Журналист", text=said[0])])
    got = both(spark, folder, "ex1_command_split")
    assert {(r["seg_id"], r["part"], r["speaker"], r["text"]) for r in got if r["seg_id"] == 0} == {(0, 1, WHO, "Полк шёл лесом к реке,"), (0, 2, "Журналист", "переговорите еще раз про ту переправу")}
    assert {r["seg_id"] for r in got} == {0, 2}


def test_introductions_and_what_is_spared(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": WHO}])
    at = lambda i, who, text, long=5: seg(i, i * 100 * S, (i * 100 + long) * S, who, text=text)
    rows = [at(0, "A", "меня зовут иначе"), at(1, "B", "меня зовут иначе"), at(2, "C", "Меня зовут Пётр"), at(3, "D", "профессор, расскажите"), at(4, "E", "он профессор?"), at(5, "F", "доктор наук он", 70), at(6, "G", "следующий вопрос про верестов"), at(7, "H", "ну да"), at(8, "I", "следующий вопрос про верестов"), at(9, "J", "доктор медицины"), at(10, WHO, "кандидат наук")]
    put(folder, "segments_merged", rows)
    got = {r["seg_id"]: r["speaker"] for r in both(spark, folder, "cl2_text_correction")}
    assert {i for i, s in got.items() if s == WHO} == {2, 8, 10}


def test_roles_of_three_speakers_and_labels_of_tapes(spark, folder, put, seg):
    put(folder, "audio_files", [{"file_id": "f", "tape_no": t, "surname": WHO} for t in (1, 2)])
    put(folder, "speaker_roles", [{"file_id": "f", "tape_no": t, "label": k, "role_name": v} for t, k, v in ((1, "SPEAKER_00", WHO), (1, "SPEAKER_01", "Журналист"), (2, "SPEAKER_00", "Журналист"), (2, "SPEAKER_01", WHO))])
    said = lambda i, s, e, raw, text, tape=1: seg(i, s * S, e * S, WHO, raw_speaker_id=raw, text=text, tape_no=tape)
    put(folder, "segments_merged", [said(1, 0, 2, "SPEAKER_02", "камера пошла"), said(2, 3, 100, "SPEAKER_00", "полк стоял"), said(3, 101, 120, "SPEAKER_01", "первый вопрос"), said(4, 121, 300, "SPEAKER_00", "и шёл", 2), said(5, 301, 302, "SPEAKER_02", "пишем"), said(6, 303, 330, "SPEAKER_01", "дальше", 2)])
    got = {r["label"]: r["role"] for r in both(spark, folder, "ag3_role_assignment")}
    assert got == {"SPEAKER_00": WHO, "SPEAKER_01": "Журналист", "SPEAKER_02": "Оператор"}
    roles = {r["seg_id"]: r["role"] for r in both(spark, folder, "jn9_roles_both_ways")}
    assert roles[2] == WHO and roles[4] == "Журналист" and roles[6] == WHO
    both(spark, folder, "jn4_dominant_role")
    both(spark, folder, "ag4_first_ten_evidence")


def test_first_rows_over_chunks(spark):
    df = spark.createDataFrame([("f", i * 7, i) for i in range(200)] + [("g", 5, 900)], "k string, start_us long, seg_id long")
    intervals_chunk = intervals.first_rows.__globals__["chunked"]
    try:
        intervals.first_rows.__globals__["chunked"] = lambda d, p: intervals_chunk(d, p, 20)
        got = intervals.first_rows(df, ["k"], 10)
        assert sorted(r.seg_id for r in got.collect()) == [*range(10), 900]
    finally:
        intervals.first_rows.__globals__["chunked"] = intervals_chunk


def test_five_texts_before_a_gap(spark, folder, put, seg):
    said = ["наша батарея держала", "дальний берег реки", "да", "нет", "так", "батарея держала дальний берег", "да", "нет", "и", "так", "вот", "батарея держала дальний берег"]
    put(folder, "segments_merged", [seg(i, i * S, (i + 1) * S, WHO, text=t, from_gap=i in (5, 11)) for i, t in enumerate(said)])
    assert {r.seg_id: r.corrupted for r in machines.mg1(spark, str(folder)).collect()} == {5: True, 11: False}
