"""Sources, sinks, readers of pages, and small machines, each on typed-in cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tapeloom.operators import folds
from tapeloom.plans import machines, texts, vocabulary
from tapeloom.sources import files
from tapeloom.sources.transcripts import read_transcripts, write_transcripts

S = 1_000_000


def test_text_files_keep_heading_and_order(spark, tmp_path):
    rows = [("f", i * S, i, f"line {i}") for i in range(500)] + [("g", 5, 1, "only")]
    files.write_txt(spark.createDataFrame(rows, "file_id string, start_us long, seg_id long, line string").repartition(7), f"file://{tmp_path}/txt")
    got = {}
    for part in sorted((tmp_path / "txt").rglob("part-*")):
        got.setdefault(part.parent.name, []).extend(part.read_text().splitlines())
    assert got == {"file_id=f": ["f", "=" * 60, *[f"line {i}" for i in range(500)]], "file_id=g": ["g", "=" * 60, "only"]}
    assert files.read_txt(spark, f"file://{tmp_path}/txt").count() == 505


def test_transcripts_by_tape_and_malformed_documents(spark, folder, put, seg, tmp_path):
    put(folder, "segments_merged", [seg(2, 5, 6, "b", text="y"), seg(1, 0, 1, "a", text="x"), seg(3, 9, 10, "c", text=None, tape_no=2)])
    path = write_transcripts(vocabulary.transcripts(spark, str(folder)), f"file://{tmp_path}/json")
    got = {(r.file_id, r.tape_no): [x.seg_id for x in r.segments] for r in read_transcripts(spark, path).collect()}
    assert got == {("f", 1): [1, 2], ("f", 2): [3]}
    (tmp_path / "json" / "broken.json").write_text("{not json\n")
    assert read_transcripts(spark, path).count() == 2
    assert [(r.n_segments, r.first_us, r.first_speaker) for r in vocabulary.snk1(spark, str(folder)).collect()] == [(3, 0, "a")]


def test_address_tables_and_logs_and_audio(spark, tmp_path):
    (tmp_path / "urls.csv").write_text("category_id,category_name,url,status_code,content_type,parseable,priority,notes\n1, Книги ,http://a/x ,200,,YES,high,\n,,http://b,,,,,\n")
    got = files.read_urls(spark, f"file://{tmp_path}/urls.csv").collect()
    assert [(r.category_name, r.url, r.parseable, r.priority, r.notes) for r in got] == [("Книги", "http://a/x", "yes", "HIGH", ""), ("", "http://b", "", "", "")]
    files.write_urls(spark.createDataFrame(got), f"file://{tmp_path}/again")
    assert files.read_urls(spark, f"file://{tmp_path}/again").count() == 2
    (tmp_path / "a.log").write_text("one\ntwo")
    assert files.read_log(spark, f"file://{tmp_path}/a.log").first().text == "one\ntwo"
    (tmp_path / "wav").mkdir()
    (tmp_path / "wav" / "x.wav").write_bytes(b"1234")
    (tmp_path / "wav" / "x.txt").write_bytes(b"1")
    assert [r.length for r in files.audio_folder(spark, f"file://{tmp_path}/wav").collect()] == [4]


def test_words_of_low_probability(spark):
    words = [("Полк", 0.9), ("занял", 0.1), ("высоту", 0.2), ("и", 0.1), ("да,", 0.1), ("насыпь", None), (None, 0.1), ("«снова»", 0.34)]
    df = spark.createDataFrame([([{"word": w, "probability": p} for w, p in words],), ([],), (None,)], "words array<struct<word string, probability double>>")
    assert [r[0] for r in df.select(texts.mask_words(F.col("words"))).collect()] == ["Полк [нрзб] и да, насыпь [нрзб]", "", None]


def test_context_in_sequence(spark):
    rows = [(1, 0, 10, "A"), (2, 10, 12, "B"), (3, 12, 14, "A"), (4, 14, 14.5, "C"), (5, 15, 30, "B"), (6, 30, 32, "A"), (7, 32, 34, "B"), (8, 34, 36, "A"), (9, 36, 50, "B"), (10, 50, 51, "A")]
    df = spark.createDataFrame([("f", i, int(s * S), int(e * S), w, "raw" + w, 2) for i, s, e, w in rows], "file_id string, seg_id long, start_us long, end_us long, speaker string, raw_speaker_id string, nw long")
    got = {r.seg_id: (r.speaker, r.raw_speaker_id) for r in folds.corrected_by_context(df).collect()}
    # 2 stands between two A; 4 begins what 5 says; 6 to 8: each sees the one before it corrected
    assert {i: w for i, (w, _) in got.items()} == {1: "A", 2: "A", 3: "A", 4: "B", 5: "B", 6: "B", 7: "B", 8: "B", 9: "B", 10: "A"}
    assert all(raw == "raw" + w for w, raw in got.values())


BOOK = {
    "http://m.example/h/book/index.html": '<html><head><title>Петров И. — Бой у реки</title></head><body><h1>Петров И. — Бой у реки</h1><ul><li><a href="01.html">1. Первые дни</a></li><li><a href="02.html">2. Зимой</a></li><li><a href="http://x.example/">Прочее</a></li></ul></body></html>',
    "http://m.example/h/book/01.html": "<html><head><title>Первые дни</title></head><body><p>Полковник Говоров принял 136-ю стрелковую дивизию. Корабль «Марат» вышел.</p></body></html>",
    "http://m.example/h/book/02.html": "<html><body><p>Генерал-майор Симоняк ждал.</p><table><tr><td class=x>Нижняя <b>Коса</b></td><td>12</td></tr></table></body></html>",
}


@pytest.fixture
def book(folder, put):
    put(folder, "rkka", [{"page_id": i, "url": u, "host": "m.example", "html": h, "status_code": 200} for i, (u, h) in enumerate(BOOK.items())] + [{"page_id": 9, "url": "http://m.example/null"}])
    return str(folder)


def test_book_from_its_contents_to_its_chapters(spark, book):
    got = machines.QUERIES["voc2h_book_crawl"](spark, book)
    rows = got.collect()
    assert rows, got.columns
    said = {str(x) for r in rows for x in r}
    assert any("Говоров" in x for x in said) and any("Марат" in x for x in said)


@pytest.mark.parametrize("name", ["voc1b_element_terms", "voc1c_combined_terms", "voc2a_authors", "voc2b_contents", "voc2g_all_patterns", "voc3b_link_texts", "voc3c_page_terms", "voc3d_directory_terms"])
def test_readers_find_what_pages_hold(spark, book, name):
    import __spark_entry__ as entry

    said = {str(x) for r in entry.queries()[name](spark, book).collect() for x in r}
    want = {"voc1b_element_terms": "Нижняя Коса", "voc1c_combined_terms": "Нижняя Коса", "voc2a_authors": "Петров", "voc2b_contents": "Первые дни", "voc2g_all_patterns": "Марат", "voc3b_link_texts": "Зимой", "voc3c_page_terms": "Нижняя Коса", "voc3d_directory_terms": "Нижняя Коса"}[name]
    assert any(want in x for x in said), said


def test_paragraphs_with_sticky_categories(spark):
    from tapeloom.plans.more import paragraph_urls

    said = ["см. http://a.example/0.", "", "КАТЕГОРИЯ 3б: Форма,  обмундирование. --- прочее", 'Там http://a.example/1, и (http://a.example/2) и "http://a.example/1"', None, "категория 4 — Карты", "http://a.example/1; http://b.example/${id}"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(said)] + [("e", 0, "http://a.example/9")], "doc_id string, pos long, text string")
    got = sorted((r.doc_id, r.pos, r.category_id, r.category_name, r.url, r.is_template) for r in paragraph_urls(df).collect())
    assert got == [
        ("d", 0, "UNKNOWN", "Unknown", "http://a.example/0", False), ("d", 3, "3Б", "Форма, обмундирование", "http://a.example/1", False), ("d", 3, "3Б", "Форма, обмундирование", "http://a.example/2", False),
        ("d", 6, "4", "Карты", "http://a.example/1", False), ("d", 6, "4", "Карты", "http://b.example/${id}", True), ("e", 0, "UNKNOWN", "Unknown", "http://a.example/9", False),
    ]


def test_marks_of_logs(spark):
    from tapeloom.plans.more import log_marks

    lines = ["🔁 LOOP x 🔁 LOOP", "GAP_FILLED", "✅ Добавлено из gaps: 3", "⏱️ 00:01 сдвиг +2.0", None]
    got = log_marks(spark.createDataFrame([("a", t) for t in lines], "k string, line string"), "k", "line").first()
    assert (got.loops, got.gaps_filled, got.shifts) == (2, 2, 1)


def gap(i, start, end, text, prev="", following="", speaker="A", next_start=None, decided="A", dominant=None):
    return {"seg_id": i, "start_us": int(start * S), "end_us": int(end * S), "text": text, "prev_text": prev, "next_text": following, "next_speaker": speaker, "next_start": next_start and int(next_start * S), "decided": decided, "dominant": dominant}


def test_filled_gaps_are_clamped_trimmed_and_attributed():
    run = lambda *rows: [(r["seg_id"], r["start_us"] / S, r["end_us"] / S, r["speaker"], r["text"]) for r in folds.fill_run(list(rows))]
    assert run(gap(1, 0, 5, "полк вышел утром", next_start=5.2), gap(2, 5.3, 9, "рота пошла лесом")) == [(1, 0, 5.2, "A", "полк вышел утром"), (2, 5.2, 9, "A", "рота пошла лесом")]
    assert run(gap(1, 0, 0.9, "полк вышел утром"), gap(2, 2, 5, "ааа"), gap(3, 6, 9, "")) == []
    assert run(gap(1, 0, 5, "стояли танки у реки", following="у реки стояли другие танки")) == []  # a restart of what follows
    assert run(gap(1, 0, 5, "расскажите о полке", decided="B", dominant="C"))[0][3] == "Журналист" and run(gap(1, 0, 5, "полк шёл", dominant="C"))[0][3] == "C"
    assert run(gap(1, 0, 5, "полк шёл к реке", prev="утром полк шёл"))[0][4] == "к реке"


def test_tolerance_join_takes_each_second_once():
    rows = [{"part": "1", "sec": s, "side": k} for k, s in [(0, 10), (0, 12), (0, 30), (0, 41), (1, 11), (1, 12), (1, 36), (1, 44), (1, 46)]]
    assert {(r["de_sec"], r["ru_sec"]) for r in folds.align_section(rows)} == {(10, 11), (12, 12), (30, None), (41, 36), (None, 44), (None, 46)}


def test_recognised_segments_and_logs_and_results(spark, tmp_path):
    (tmp_path / "asr").mkdir()
    (tmp_path / "asr" / "a.json").write_text('{"file_id": "f", "segments": [{"start": 0.5, "end": 2.000001, "text": "Полк", "avg_logprob": -0.2, "words": [{"word": "Полк", "start": 0.5, "end": 1, "probability": 0.9}]}, {"start": 3, "end": 4}]}\n{broken\n{"segments": []}\n')
    got = files.read_asr(spark, f"file://{tmp_path}/asr").orderBy("pos").collect()
    assert [(r.file_id, r.start_us, r.end_us, r.text, r.words and r.words[0].probability) for r in got] == [("f", 500_000, 2_000_001, "Полк", 0.9), ("f", 3_000_000, 4_000_000, None, None)]
    lines = spark.createDataFrame([("merge" if i % 2 else None, i, f"line {i}") for i in range(50)], "phase string, at int, line string").repartition(5)
    files.write_log(lines, f"file://{tmp_path}/log")
    read = lambda name: [x for p in sorted((tmp_path / "log" / f"log={name}").glob("part-*")) for x in p.read_text().splitlines()]
    assert read("main") == [f"line {i}" for i in range(50)] and read("phase-merge") == [f"line {i}" for i in range(1, 50, 2)]
    for _ in range(2):
        files.publish({"lines": lines}, f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out/lines").count() == 50


def test_pages_are_fetched_once_with_retries_and_pauses(spark, tmp_path):
    import datetime as dt

    from tapeloom.sources.fetch import fetch_missing

    log = str(tmp_path / "calls")

    def get(url: str) -> str:
        import time

        with open(log, "a+") as f:
            f.seek(0)
            before = sum(x.startswith(url + " ") for x in f)
            f.write(f"{url} {time.time()}\n")
        if url.endswith("bad"):
            raise ValueError("no such page")
        if url.endswith("slow") and before < 1:
            raise TimeoutError("late")
        if url.endswith("down"):
            raise ConnectionError("refused")
        return "page of " + url

    now = dt.datetime.now()
    urls = spark.createDataFrame([(f"http://h.example/{x}",) for x in ("new", "bad", "slow", "down", "kept", "old", "new")], "url string")
    cache = spark.createDataFrame([("http://h.example/kept", "older", now - dt.timedelta(days=2)), ("http://h.example/kept", "cached", now), ("http://h.example/old", "stale", now - dt.timedelta(days=30))], "url string, html string, fetched_at timestamp")
    got = {r.url.rpartition("/")[2]: (r.html, r.error) for r in fetch_missing(urls, cache, get, tries=3, wait_s=0.01, pause_s=0.2).collect()}
    page = lambda x: ("page of http://h.example/" + x, None)
    assert got == {"new": page("new"), "bad": (None, "no such page"), "slow": page("slow"), "down": (None, "refused"), "kept": ("cached", None), "old": page("old")}
    calls = [x.split() for x in open(log)]
    count = lambda x: sum(u.endswith(x) for u, _ in calls)
    assert (count("new"), count("bad"), count("slow"), count("down"), count("kept")) == (1, 1, 2, 3, 0)
    # one host comes to one task, which waits between two addresses
    last = {}
    for u, t in calls:
        if last and u not in last:
            assert float(t) - max(last.values()) >= 0.19
        last[u] = float(t)
