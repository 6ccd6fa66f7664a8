"""Further sources, sinks and dictionary stages, each through the library's reader or writer."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.text import hms, seconds_of
from tapeloom.operators import folds
from tapeloom.operators import vocabulary as V
from tapeloom.operators.ordered import with_last, with_stretches
from tapeloom.plans.base import ORDER, SEG, TERMS, TURNS, read, segments, terms, turns
from tapeloom.plans.intervals import NEXT, pairs
from tapeloom.plans.machines import page_terms
from tapeloom.plans.texts import TXT, texts
from tapeloom.plans.vocabulary import PARSE, PRIO, REASON, VT, distinct_terms, domain
from tapeloom.session import shared_folder
from tapeloom.sources.files import read_urls, write_urls
from tapeloom.sources.term_files import read_dictionary

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: str = ""):  # noqa: ANN201
    def keep(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {base} {sql}" if base else sql
        return f

    return keep


def folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tapeloom/{label}-{uuid.uuid4().hex}"


@query("src2_diarization_turns", "SELECT file_id, turn_id, start_us, end_us, label FROM turns", f"{SEG}, {TURNS}")
def src2(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d)


@query("src4_gap_segments", "SELECT file_id, seg_id, start_us - 1000000 AS slice_from_us, end_us + 1000000 AS slice_to_us FROM seg WHERE from_gap", SEG)
def src4(spark: SparkSession, d: str) -> DataFrame:
    """Segments that came from gaps, with the slice of audio that is read for one: a second more on both sides."""
    return segments(spark, d, "from_gap").filter("from_gap").select("file_id", "seg_id", F.expr("start_us - 1000000").alias("slice_from_us"), F.expr("end_us + 1000000").alias("slice_to_us"))


@query("src8_dictionary_lines", "SELECT DISTINCT term, weight FROM vocab WHERE term IS NOT NULL AND weight IS NOT NULL")
def src8(spark: SparkSession, d: str) -> DataFrame:
    """The dictionary written as lines term:weight and read again."""
    path = folder(spark, "dictionary")
    read(spark, d, "vocab").filter("term is not null and weight is not null").select(F.concat_ws(":", "term", F.col("weight").cast("string")).alias("value")).write.text(path)
    return read_dictionary(spark, path).distinct()


@query("snk4_term_file_names", "SELECT DISTINCT regexp_replace(source, '[^A-Za-z0-9]+', '_', 'g') || '__' || md5(source)[1:8] || '.txt' AS name FROM terms", TERMS)
def snk4(spark: SparkSession, d: str) -> DataFrame:
    return terms(spark, d).select(F.concat(F.regexp_replace("source", "[^A-Za-z0-9]+", "_"), F.lit("__"), F.substring(F.md5("source"), 1, 8), F.lit(".txt")).alias("name")).distinct()


@query("snk6_clean_dictionary", f"SELECT term FROM dt WHERE {REASON} = 'kept'", VT)
def snk6(spark: SparkSession, d: str) -> DataFrame:
    return distinct_terms(spark, d).filter(V.reject_reason(F.col("term")) == "kept")


@query("snk8_audit_csv", f"SELECT url, coalesce(CAST(min(status_code) AS VARCHAR), '') AS status_code, lower({PARSE.replace('status_code', 'min(status_code)')}) AS parseable, {PRIO} AS priority FROM rkka WHERE url IS NOT NULL GROUP BY url")
def snk8(spark: SparkSession, d: str) -> DataFrame:
    """The audit as CSV with its eight columns, written and read again."""
    path, u = folder(spark, "audit"), F.col("url")
    r = read(spark, d, "rkka").filter("url is not null").groupBy("url").agg(F.min("status_code").alias("status"))
    cols = {"category_id": F.lit(""), "category_name": F.lit(""), "status_code": F.col("status").cast("string"), "content_type": F.lit("text/html"), "parseable": V.parse_method(u, domain(u), F.col("status")), "priority": V.priority(domain(u)), "notes": F.lit("")}
    write_urls(r.withColumns(cols), path)
    return read_urls(spark, path).select("url", "status_code", "parseable", "priority")


@query("tx19_clock_functions", "SELECT seg_id, format('{:02d}:{:02d}:{:02d}', s // 3600, (s % 3600) // 60, s % 60) AS hms, s AS sec FROM (SELECT seg_id, CAST(floor(start_us / 1e6) AS BIGINT) AS s FROM seg)", SEG)
def tx19(spark: SparkSession, d: str) -> DataFrame:
    """Seconds to HH:MM:SS and back, without wrapping at 24 hours."""
    return segments(spark, d).select("seg_id", hms(F.col("start_us")).alias("hms")).withColumn("sec", seconds_of(F.col("hms")))


@query("voc8_url_audit", f"SELECT page_id, {PARSE} AS method, {PRIO} AS priority, CASE WHEN status_code IS NULL THEN 'error' WHEN status_code >= 400 THEN 'dead' ELSE 'live' END AS state FROM rkka WHERE url IS NOT NULL")
def voc8(spark: SparkSession, d: str) -> DataFrame:
    u, s = F.col("url"), F.col("status_code")
    return read(spark, d, "rkka").filter("url is not null").select("page_id", V.parse_method(u, domain(u), s).alias("method"), V.priority(domain(u)).alias("priority"), F.when(s.isNull(), "error").when(s >= 400, "dead").otherwise("live").alias("state"))


@query("voc9_hosts_in_turn", "SELECT host, count(*) AS n_requests, CAST(count(*) - 1 AS DOUBLE) AS least_seconds FROM rkka WHERE host IS NOT NULL GROUP BY host")
def voc9(spark: SparkSession, d: str) -> DataFrame:
    """What a pause of one second between two requests of a host costs; sources/fetch.py keeps it."""
    return read(spark, d, "rkka").filter("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n_requests")).withColumn("least_seconds", (F.col("n_requests") - 1).cast("double"))


_AGAIN = r"len([1 FOR i IN range(1, len(p)) IF length(p[i]) >= 20 AND starts_with(p[i + 1], p[i])]) > 0"
_STUTTER = r"len([1 FOR i IN range(1, len(q)) IF q[i] = q[i + 1] AND length(q[i]) >= 3]) > 0"


@query("qa4_checklist", rf"SELECT item, label, CAST(n AS BIGINT) AS n, CASE WHEN item IN (4, 6, 8) THEN 'MANUAL' WHEN n = 0 THEN 'GREEN' WHEN item IN (3, 7) THEN 'CHECK' ELSE 'RED' END AS status FROM (SELECT 1 AS item, 'long blocks' AS label, count(*) FILTER (WHERE end_us - start_us > 30000000 AND NOT regexp_matches(text, '\d{{2}}:\d{{2}}:\d{{2}}')) AS n FROM tx UNION ALL SELECT 2, 'repeated phrases', count(*) FILTER (WHERE {_AGAIN}) FROM (SELECT regexp_split_to_array(text, '[.!?]\s+') AS p FROM tx) UNION ALL SELECT 3, 'stuttering', count(*) FILTER (WHERE {_STUTTER}) FROM (SELECT regexp_split_to_array(t, '[^\p{{L}}\p{{N}}]+') AS q FROM tx) UNION ALL SELECT 4, 'invented endings', 0 UNION ALL SELECT 5, 'adjacent replicas', count(*) FILTER (WHERE n_spk = speaker) FROM nb UNION ALL SELECT 6, 'drift', 0 UNION ALL SELECT 7, 'gaps over 3 s', count(*) FILTER (WHERE n_start - end_us > 3000000) FROM nb UNION ALL SELECT 8, 'regression', 0)", f"{SEG}, {TXT}, {NEXT}")
def qa4(spark: SparkSession, d: str) -> DataFrame:
    """The eight items of the checklist: how often each is broken, and its status; three are for people."""
    t = texts(spark, d)
    two = lambda p, e: F.exists(F.arrays_zip(F.expr(f"slice({p}, 1, greatest(size({p}) - 1, 0))").alias("a"), F.expr(f"slice({p}, 2, greatest(size({p}) - 1, 0))").alias("b")), e)
    t = t.withColumns({"p": F.split("text", r"[.!?]\s+"), "q": F.split("t", r"[^\p{L}\p{N}]+")})
    long = (F.col("end_us") - F.col("start_us") > 30_000_000) & ~F.col("text").rlike(r"\d{2}:\d{2}:\d{2}")
    again, stutter = two("p", lambda x: (F.length(x["a"]) >= 20) & F.startswith(x["b"], x["a"])), two("q", lambda x: (x["a"] == x["b"]) & (F.length(x["a"]) >= 3))
    said = t.agg(F.count_if(long).alias("n1"), F.count_if(again).alias("n2"), F.count_if(stutter).alias("n3"))
    order = pairs(spark, d, "speaker").agg(F.count_if(F.expr("next_speaker = speaker")).alias("n5"), F.count_if(F.expr("next_start_us - end_us > 3000000")).alias("n7"))
    items = {1: ("long blocks", "n1"), 2: ("repeated phrases", "n2"), 3: ("stuttering", "n3"), 4: ("invented endings", None), 5: ("adjacent replicas", "n5"), 6: ("drift", None), 7: ("gaps over 3 s", "n7"), 8: ("regression", None)}
    rows = F.array(*[F.struct(F.lit(k).alias("item"), F.lit(label).alias("label"), (F.col(n) if n else F.lit(0)).cast("long").alias("n")) for k, (label, n) in items.items()])
    r = said.join(F.broadcast(order)).select(F.explode(rows).alias("x")).select("x.*")  # one row each
    status = F.when(F.col("item").isin(4, 6, 8), "MANUAL").when(F.col("n") == 0, "GREEN").when(F.col("item").isin(3, 7), "CHECK").otherwise("RED")
    return r.withColumn("status", status)


def log_marks(lines: DataFrame, key: str, column: str) -> DataFrame:
    """AG12: how often a run's log says that it cut a loop, filled a gap or moved a clock mark."""
    n = lambda p: F.sum(F.regexp_count(F.col(column), F.lit(p))).cast("long")
    return lines.groupBy(key).agg(n("🔁 LOOP").alias("loops"), n("GAP_FILLED|✅ Добавлено из gaps").alias("gaps_filled"), n(r"⏱️.*сдвиг \+").alias("shifts"))


@query("ag12_log_marks", "SELECT file_id, CAST(sum(len(regexp_extract_all(line, '🔁 LOOP'))) AS BIGINT) AS loops, CAST(sum(len(regexp_extract_all(line, 'GAP_FILLED|✅ Добавлено из gaps'))) AS BIGINT) AS gaps_filled, CAST(sum(len(regexp_extract_all(line, '⏱️.*сдвиг \\+'))) AS BIGINT) AS shifts FROM (SELECT file_id, raw_speaker_id || CASE WHEN from_gap THEN ' ✅ Добавлено из gaps ' ELSE ' ' END || coalesce(text, '') AS line FROM seg) GROUP BY file_id", SEG)
def ag12_marks(spark: SparkSession, d: str) -> DataFrame:
    """The marks of logs, counted in a log written from the segments: their label, whether a gap gave them, their text."""
    r = segments(spark, d, "raw_speaker_id", "text", "from_gap")
    line = F.concat("raw_speaker_id", F.when(F.col("from_gap"), " ✅ Добавлено из gaps ").otherwise(" "), F.coalesce("text", F.lit("")))
    return log_marks(r.select("file_id", line.alias("line")), "file_id", "line")


def paragraph_urls(paragraphs: DataFrame) -> DataFrame:
    """SRC10 on (doc_id, pos, text), paragraphs in order: category_id, category_name, url, is_template.

    A heading of a category holds until the next; an address counts once in each block of a category; paragraphs before any heading are of category UNKNOWN."""
    text = F.trim(F.regexp_replace("text", r"(?U)\s+", " "))
    heading = r"(?iu)КАТЕГОРИЯ\s+(\d+[бБ]?)\s*[:\-–—]?\s*(.+)"
    p = paragraphs.filter("text is not null").select("doc_id", "pos", text.alias("x")).filter("x <> ''").withColumn("is_head", F.col("x").rlike(heading))
    name = F.rtrim(F.trim(F.split(F.regexp_extract("x", heading, 2), "---|—")[0]), F.lit("."))
    p = p.withColumn("head", F.when(F.col("is_head"), F.struct(F.upper(F.regexp_extract("x", heading, 1)).alias("id"), name.alias("name"), F.col("pos").alias("at"))))
    p = with_last(p, "doc_id", ["pos"], F.col("head"), "sticky", chunk=1000).filter(~F.col("is_head"))
    urls = p.select("doc_id", "pos", "sticky", F.posexplode(F.expr(r"""regexp_extract_all(x, 'https?://[^\\s\\]>"\'<\\)]+', 0)""")).alias("i", "url")).withColumn("url", F.rtrim(F.col("url"), F.lit(".,;:!?)\"'\\"))).filter("url <> ''")
    first = urls.groupBy("doc_id", F.coalesce("sticky.at", F.lit(-1)).alias("block"), "url").agg(F.min(F.struct("pos", "i")).alias("place"), F.first("sticky").alias("sticky"))
    return first.select("doc_id", F.coalesce("sticky.id", F.lit("UNKNOWN")).alias("category_id"), F.coalesce("sticky.name", F.lit("Unknown")).alias("category_name"), "url", F.col("url").rlike(r"[$\{]").alias("is_template"), F.col("place.pos").alias("pos"))


@query("src10_paragraph_scan", r"""SELECT host AS doc_id, '1' AS category_id, upper(host) AS category_name, url, regexp_matches(url, '[$\{]') AS is_template, min(page_id) AS pos FROM (SELECT host, rtrim(url, '.,;:!?)') AS url, page_id FROM rkka WHERE host IS NOT NULL AND regexp_matches(url, '^https?://[^\s<>)]+$')) GROUP BY ALL""")
def src10_scan(spark: SparkSession, d: str) -> DataFrame:
    """The scan of a document's paragraphs, on one document for each host: a heading, then a sentence for each page with its address."""
    r = read(spark, d, "rkka").filter("host is not null and url is not null")
    said = r.select(F.col("host").alias("doc_id"), F.col("page_id").alias("pos"), F.concat(F.lit("Смотри  "), F.col("url"), F.lit(" , там же.")).alias("text"))
    heads = r.select("host").distinct().select(F.col("host").alias("doc_id"), F.lit(-1).cast("long").alias("pos"), F.concat(F.lit("Категория 1: "), F.upper("host"), F.lit(" — описание.")).alias("text"))
    return paragraph_urls(heads.unionByName(said))


@query("voc1d_latin_side_file")
def voc1d(spark: SparkSession, d: str) -> DataFrame:
    """Terms of English pages without Cyrillic letters, which go to a file of their own as well."""
    return page_terms(read(spark, d, "rkka").filter("html like '%lang=\"en\"%' or html like '%lang=en>%'")).filter(~F.col("term").rlike("[А-ЯЁа-яё]") & F.length("term").between(3, 80)).select("page_id", "term").distinct()


@query("voc3d_directory_terms")
def voc3d(spark: SparkSession, d: str) -> DataFrame:
    """Cells and link texts of a host, the first page that has a term first, each term once without regard to case."""
    p = page_terms(read(spark, d, "rkka").filter("html is not null")).filter(F.col("kind").isin("a", "td") & F.length("term").between(3, 80) & F.col("term").rlike("[А-ЯЁа-яё]"))
    p = p.join(read(spark, d, "rkka").select("page_id", "host"), "page_id")
    return p.groupBy("host", F.lower("term").alias("low")).agg(F.min_by("term", F.struct("page_id", "pos")).alias("term"))


@query("dd3_overlapping_segments")
def dd3(spark: SparkSession, d: str) -> DataFrame:
    """Of segments that lie to three tenths or more in the one kept before, the one that ends later stays; a start after all ends before it parts the groups."""
    r = with_stretches(segments(spark, d).filter("end_us > start_us"), "file_id", ORDER, 0, "near")
    return folds.fold(r, ["file_id", "near"], ORDER, keep_later, "seg_id bigint, start_us bigint, end_us bigint")


def keep_later(rows: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in rows:
        x = {k: r[k] for k in ("seg_id", "start_us", "end_us")}
        if out:
            shared = min(out[-1]["end_us"], x["end_us"]) - max(out[-1]["start_us"], x["start_us"])
            if shared / (x["end_us"] - x["start_us"]) >= 0.3:
                if x["end_us"] > out[-1]["end_us"]:
                    out[-1] = x
                continue
        out.append(x)
    return out
