"""The dictionary over the corpus: counts, weights, cases, and the four layers of the corrector; each against its SQL or brute force."""

from __future__ import annotations

import random

import duckdb
import pytest

import __spark_entry__ as entry
from tapeloom.operators import term_counts as TC
from tapeloom.operators import vocabulary as V
from tapeloom.plans import vocabulary as P


def both(spark, folder, name):
    got = entry.queries()[name](spark, str(folder))
    con = duckdb.connect()
    for t in ("segments_merged", "audio_files", "role_aliases", "documents", "vocab"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    r = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == sorted(got.columns)
    rows = got.select(*names).collect()
    assert sorted(map(repr, (tuple(x) for x in rows))) == sorted(map(repr, r.fetchall()))
    return [x.asDict() for x in rows]


@pytest.mark.parametrize("block", [2, 1000])
def test_counts_of_terms_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(TC, "BLOCK", block)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("абАБ ") for _ in range(rnd.randrange(60))) for _ in range(40)] + [None, "", "ааааа"]
    terms = ["аа", "аба", "Б", "аб а", "б", None, " ", "ббббб", "АА"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {r.low: r.n for r in TC.term_counts(df, "text", spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    want = {t.lower(): sum((x or "").lower().count(t.lower()) for x in texts) for t in terms if t and t.strip()}
    assert got == {t: n for t, n in want.items() if n}
    assert TC.term_counts(df, "text", spark.createDataFrame([], "term string")).count() == 0


TEXTS = ["Генерал Коварова держал оборону. ГОВОРОВ ждал. Под приладожье шли танки, плацдарм взяли.", "Майор Симонякк и майор Симоняк спорили; плоцдарм у Приладожья.", "Капитан Ветров, капитан Ведров и лейтенант Ветроф.", None, "", "говоров говоров"]
TERMS = [("генерал Говоров", 5, "person"), ("майор Симоняк", 4, "person"), ("капитан Ветров", 2, "person"), ("Приладожье", 3, "toponym"), ("Плацдарм", 1, "toponym"), ("136-я стрелковая дивизия", 2, "unit"), (None, 1, "unit"), ("Говоров", 1, "toponym")]


@pytest.fixture
def corpus(folder, put):
    put(folder, "documents", [{"doc_id": i, "text": t} for i, t in enumerate(TEXTS)])
    put(folder, "vocab", [{"term": t, "weight": w, "category": c} for t, w, c in TERMS])
    put(folder, "audio_files", [{"file_id": "f", "tape_no": 1, "surname": "Müller-Говоров"}, {"file_id": "g", "tape_no": 1}])
    return folder


def test_layers_of_the_corrector(spark, corpus):
    assert {(r["w"], r["v"]) for r in both(spark, corpus, "voc10_case_corrector")} == {("ГОВОРОВ", "Говоров"), ("приладожье", "Приладожье"), ("плацдарм", "Плацдарм"), ("говоров", "Говоров")}
    fuzzy = {r["w"]: (r["v"], r["dist"]) for r in both(spark, corpus, "voc11_dictionary_corrector")}
    assert fuzzy["симонякк"] == ("Симоняк", 1) and fuzzy["плоцдарм"] == ("Плацдарм", 1) and fuzzy["ведров"] == ("Ветров", 1) and fuzzy["приладожья"] == ("Приладожье", 1) and "танки" not in fuzzy
    assert {r["w"]: r["v"] for r in both(spark, corpus, "voc12_surname_corrector")} == {"коварова": "Говоров", "ведров": "Ветров", "ветроф": "Ветров"}
    titled = {(r["title"], r["w"]): r["v"] for r in both(spark, corpus, "voc13_title_corrector")}
    assert titled == {("генерал", "коварова"): "Говоров", ("майор", "симонякк"): "Симоняк", ("капитан", "ведров"): "Ветров"}


def test_the_best_candidate(spark):
    rows = [("x", "ab", 1, 2), ("x", "abc", 2, 2), ("x", "abd", 2, 1), ("x", "zz", 9, 3), ("y", "a", 1, 1), ("y", "bb", 1, 1)]
    df = spark.createDataFrame(rows, "w string, v string, weight int, dist int")
    assert {(r.w, r.v) for r in V.best_of(df, ["w"]).collect()} == {("x", "zz"), ("y", "bb")}


def test_fuzzy_words_of_cyrillic_against_all_pairs(spark):
    from test_ordered_and_folds import distance

    words, known = ["полк", "палк", "полька", "рота", "ротта", "дивизия"], ["полк", "рота", "дивизии", "плк"]
    k = spark.createDataFrame([(x, x, 1, False) for x in known], "k string, v string, weight int, who boolean")
    got = {(r.w, r.k, r.dist) for r in P.fuzzy(spark.createDataFrame([(w,) for w in words], "w string"), k).collect()}
    assert got == {(a, b, distance(a, b)) for a in words for b in known if distance(a, b) <= 2}


def test_weights_by_the_corpus(spark, corpus):
    got = {r["term"]: (r["n"], r["weight"]) for r in both(spark, corpus, "voc7_frequency_weights")}
    assert got["Говоров"] == (3, 5) and got["майор Симоняк"] == (2, 5) and got["136-я стрелковая дивизия"] == (1, 4)
    assert {r["low"]: r["n"] for r in both(spark, corpus, "jn14_frequency_in_corpus")} == {"говоров": 3, "майор симоняк": 2, "капитан ветров": 1, "приладожье": 1, "плацдарм": 1}


@pytest.mark.parametrize(("term", "normal"), [("1-го Белорусского фронта", "1-го Белорусский фронт"), ("Ленинградской армией", "Ленинградская армия"), ("стрелковой дивизией", "стрелковой дивизия"), ("штабом корпуса", "штаб корпус"), ("Жуковым", "Жуков"), ("Тимошенко", "Тимошенко"), ("армии армии", "армия армия")])
def test_cases_are_brought_back(spark, term, normal):
    import pyspark.sql.functions as F

    assert spark.createDataFrame([(term,)], "t string").select(V.normalize_case(F.col("t"))).first()[0] == normal


def test_aliases_of_the_valid_delivery(spark, folder, put, seg):
    import datetime as dt

    put(folder, "role_aliases", [{"alias": "Ведущий ", "role_name": "Журналист"}, {"alias": "Я", "role_name": "Спикер"}])
    put(folder, "segments_merged", [seg(1, 0, 1, "Я", loaded_at=dt.datetime(2024, 1, 1)), seg(1, 0, 1, " ведущий", loaded_at=dt.datetime(2024, 1, 2)), seg(2, 0, 1, None), seg(3, 0, 1, "кто-то")])
    assert both(spark, folder, "voc14_alias_table") == [{"seg_id": 1, "role_name": "Журналист"}]
