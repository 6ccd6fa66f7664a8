"""Queries of the ordered state machines and matchers; SQL cannot say them, so fixtures in tests/ hold their results."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y
from pyspark.sql import Window as W

from tapeloom.functions import lexicon as X
from tapeloom.functions import matching as M
from tapeloom.functions.text import any_hit, n_words
from tapeloom.operators import folds
from tapeloom.operators import vocabulary as V
from tapeloom.operators.ordered import with_islands, with_neighbours, with_running_sum
from tapeloom.plans.base import ORDER, pages, read, segments
from tapeloom.plans.intervals import jn4, label_of, tape_roles
from tapeloom.plans.texts import score, texts, txt_blocks

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str):  # noqa: ANN201
    def keep(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        return f

    return keep


def map_text(df: DataFrame, fn, columns: list[str], out: str = "text", kind: Y.DataType | None = None) -> DataFrame:  # noqa: ANN001
    """seg_id and fn of the columns, in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"seg_id": b["seg_id"], out: [fn(*r) for r in zip(*[b[c] for c in columns], strict=True)]})

    schema = Y.StructType([Y.StructField("seg_id", Y.LongType()), Y.StructField(out, kind or Y.StringType())])
    return df.select("seg_id", *columns).mapInPandas(run, schema)


def surnames(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))


@query("wn8_replica_merge")
def wn8(spark: SparkSession, d: str) -> DataFrame:
    return folds.merge_replicas(segments(spark, d, "speaker", "raw_speaker_id", "text", "from_gap"))


@query("wn3_context_speaker")
def wn3(spark: SparkSession, d: str) -> DataFrame:
    """The correction by context in sequence: a row sees the one before it as corrected."""
    r = segments(spark, d, "speaker", "raw_speaker_id", "text").withColumn("nw", n_words(F.coalesce("text", F.lit(""))))
    return folds.corrected_by_context(r.drop("text"))


@query("wn9_boundary_carry")
def wn9(spark: SparkSession, d: str) -> DataFrame:
    return folds.boundary_carry(segments(spark, d, "speaker", "text").join(surnames(spark, d), "file_id", "left"))


def classified(r: DataFrame, schema: str = "seg_id bigint, speaker string") -> DataFrame:
    """CL1 on (file_id, seg_id, start_us, end_us, speaker, surname, text): the pass with its memory; ``schema`` names the columns that come out.

    Groups part only where the speaker changes whatever the memory holds: between two rows that are no continuations and whose speakers differ."""
    carried = [c.split()[0] for c in folds._columns(schema)]
    r = r.withColumns({"t": F.lower("text"), "nw": F.size(F.filter(F.split("text", " "), lambda x: x != "")).cast("long")})
    r = r.withColumns({"j": score("j"), "s": score("s"), "continues": any_hit(F.col("t"), X.CONTINUATION_CLASSIFY)})
    r = with_neighbours(r, "file_id", ORDER, ["end_us"], after=None).withColumnRenamed("prev_end_us", "prev_end")
    weighed = (F.col("nw") >= 5) & (F.col("speaker") != folds.OPERATOR)
    alone = F.when(weighed & (F.col("speaker") == F.col("surname")) & (F.col("j") - F.col("s") > 3), folds.JOURNALIST)
    alone = alone.when(weighed & (F.col("speaker") == folds.JOURNALIST) & (F.col("s") - F.col("j") > 3), F.col("surname")).otherwise(F.col("speaker"))
    r = r.withColumns({"alone": alone, "leans": F.coalesce(weighed & F.col("continues"), F.lit(False))})
    r = with_islands(r, "file_id", ORDER, ["alone", "leans"], F.coalesce(~F.col("prev_leans") & ~F.col("leans") & (F.col("prev_alone") != F.col("alone")), F.col("prev_leans").isNull()), "near")
    need = ["file_id", "near", "start_us", "seg_id", "speaker", "surname", "nw", "j", "s", "continues"]
    r = r.select(*need, *[c for c in carried if c not in need], F.coalesce("prev_end", "start_us").alias("prev_end"))
    return folds.fold(r, ["file_id", "near"], ORDER, folds.classify_run, schema)


@query("cl1_classification")
def cl1(spark: SparkSession, d: str) -> DataFrame:
    return classified(texts(spark, d, "speaker").drop("t", "nw").join(surnames(spark, d), "file_id"))


@query("cl1_labels_in_step")
def cl1_labels(spark: SparkSession, d: str) -> DataFrame:
    """The classification pass with raw labels in step: whose speaker it changed takes the label of the new speaker on its tape, where there is one."""
    r = segments(spark, d, "tape_no", "speaker", "raw_speaker_id").withColumnRenamed("speaker", "was").join(cl1(spark, d), "seg_id")
    r = r.join(label_of(spark, d), ["file_id", "tape_no", "speaker"], "left")
    raw = F.when(F.col("was") != F.col("speaker"), F.coalesce("label_of_speaker", "raw_speaker_id")).otherwise(F.col("raw_speaker_id"))
    return r.select("seg_id", "speaker", raw.alias("raw_speaker_id"))


def split_mixed(rows: DataFrame) -> DataFrame:
    """EX2 on (file_id, tape_no, seg_id, start_us, end_us, speaker, raw_speaker_id, surname, text), other columns carried along: the parts, numbered from 1; one row is one row where one person speaks."""
    keep = ["file_id", "tape_no", "seg_id", "raw_speaker_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = [M.split_speakers(t or "", s, n, int(x), int(y)) for t, s, n, x, y in zip(b["text"], b["speaker"], b["surname"], b["start_us"], b["end_us"], strict=True)]
            many = b[keep].loc[b.index.repeat([len(p) for p in parts])].reset_index(drop=True)
            flat = pd.DataFrame([(k + 1, len(p), *x) for p in parts for k, x in enumerate(p)], columns=["part", "n_parts", "speaker", "text", "start_us", "end_us"])
            yield pd.concat([many, flat], axis=1)

    extra = [f for f in rows.schema if f.name not in (*keep, "start_us", "end_us", "speaker", "surname", "text")]
    keep += [f.name for f in extra]
    shape = "file_id string, tape_no int, seg_id bigint, raw_speaker_id string, " + "".join(f"{f.name} {f.dataType.simpleString()}, " for f in extra) + "part int, n_parts int, speaker string, text string, start_us bigint, end_us bigint"
    return rows.select(*keep, "start_us", "end_us", "speaker", "surname", "text").mapInPandas(run, shape)


@query("ex2_mixed_speakers")
def ex2(spark: SparkSession, d: str) -> DataFrame:
    """Replicas in which two people speak, in parts with their speakers, shares of time and the labels of those speakers on the tape."""
    r = segments(spark, d, "tape_no", "speaker", "raw_speaker_id", "text").filter("text is not null").join(surnames(spark, d), "file_id", "left")
    r = split_mixed(r.select("file_id", "tape_no", "seg_id", "start_us", "end_us", "speaker", "raw_speaker_id", "surname", "text")).filter("n_parts > 1").join(label_of(spark, d), ["file_id", "tape_no", "speaker"], "left")
    return r.select("seg_id", "part", "speaker", F.coalesce("label_of_speaker", "raw_speaker_id").alias("raw_speaker_id"), "start_us", "end_us", "text")


@query("ex5_sentence_times")
def ex5(spark: SparkSession, d: str) -> DataFrame:
    """The time of the first word of every sentence of a merged replica, along the word counts of all its members."""
    kind = Y.ArrayType(Y.LongType())

    def times(text: str, start: int, end: int, subs: str) -> list[int]:
        said = [len(x.split()) for x in re.split(r"(?<=[.!?])\s+", text.strip())]
        members = [(m["start_us"], m["end_us"], m["words"]) for m in json.loads(subs)]
        return [int(M.time_of_word(sum(said[:k]), sum(said), int(start), int(end), members)) for k in range(len(said))]

    r = wn8(spark, d).withColumn("subs", F.to_json("sub_segments"))
    return map_text(r, times, ["text", "start_us", "end_us", "subs"], "times", kind).select("seg_id", F.posexplode("times").alias("sentence", "at_us"))


@query("jn3_map_speaker")
def jn3(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    r = segments(spark, d, "tape_no", "raw_speaker_id", "text").join(a, "file_id").join(tape_roles(spark, d).withColumnRenamed("label", "raw_speaker_id"), ["file_id", "tape_no", "raw_speaker_id"], "left")
    r = r.withColumn("asks", any_hit(F.lower(F.coalesce("text", F.lit(""))), [*X.STRONG, X.QUESTION[0]])).drop("text")
    return folds.map_speakers(r)


@query("jn8_gap_fill_chain")
def jn8(spark: SparkSession, d: str) -> DataFrame:
    """Segments from gaps, attributed and trimmed against their neighbours."""
    r = with_neighbours(segments(spark, d, "speaker", "text", "from_gap"), "file_id", ORDER, ["start_us", "end_us", "speaker", "text"])
    p, n = F.col("prev_speaker"), F.col("next_speaker")
    r = r.withColumn("decided", F.when(p == n, p).otherwise(F.coalesce(n, p, F.lit("Неизвестно"))))
    r = r.filter("from_gap").join(jn4(spark, d).select("seg_id", F.col("role").alias("dominant")), "seg_id", "left")
    r = r.select("file_id", "start_us", "seg_id", "end_us", "text", "prev_text", "next_text", "next_speaker", "decided", "dominant", F.col("next_start_us").alias("next_start"))
    near = with_islands(r, "file_id", ORDER, ["end_us"], F.coalesce(F.col("start_us") - F.col("prev_end_us") > 1_000_000, F.lit(True)), "near")
    return folds.fold(near, ["file_id", "near"], ORDER, folds.fill_run, "seg_id bigint, start_us bigint, end_us bigint, speaker string, text string")


@query("dd1_cross_speaker_near")
def dd1(spark: SparkSession, d: str) -> DataFrame:
    return folds.near_duplicates(segments(spark, d, "speaker", "text"), across=True)


@query("dd2_same_speaker_near")
def dd2(spark: SparkSession, d: str) -> DataFrame:
    return folds.near_duplicates(segments(spark, d, "speaker", "text"), across=False)


@query("dd4_seam_join")
def dd4(spark: SparkSession, d: str) -> DataFrame:
    r = with_neighbours(segments(spark, d, "text").filter("text is not null"), "file_id", ORDER, ["text"], before=None).filter("next_text is not null")
    return map_text(r, lambda a, b: M.joined([a, b]), ["text", "next_text"])


@query("dd5_seam_words")
def dd5(spark: SparkSession, d: str) -> DataFrame:
    r = with_neighbours(segments(spark, d, "text").filter("text is not null"), "file_id", ORDER, ["text"], before=None).filter("next_text is not null")
    return map_text(r, M.seam, ["text", "next_text"], "n", Y.IntegerType()).filter("n > 0")


@query("tx1_similarity_to_next")
def tx1(spark: SparkSession, d: str) -> DataFrame:
    r = with_neighbours(segments(spark, d, "text").filter("text is not null"), "file_id", ORDER, ["text"], before=None).filter("next_text is not null")
    return map_text(r, M.similarity, ["text", "next_text"], "ratio", Y.DoubleType())


@query("prd13_continuation_of_last")
def prd13(spark: SparkSession, d: str) -> DataFrame:
    r = with_neighbours(segments(spark, d, "text").filter("text is not null"), "file_id", ORDER, ["text"], after=None).filter("prev_text is not null")
    return map_text(r, lambda a, b: M.similarity(a, b) >= 0.90, ["text", "prev_text"], "again", Y.BooleanType()).filter("again")


def trims(spark: SparkSession, d: str) -> DataFrame:
    return with_neighbours(segments(spark, d, "text", "from_gap").filter("text is not null"), "file_id", ORDER, ["text"]).filter("from_gap")


@query("tx2_trim_before_next")
def tx2(spark: SparkSession, d: str) -> DataFrame:
    return map_text(trims(spark, d).filter("next_text is not null"), M.trim_before, ["text", "next_text"])


@query("tx3_trim_after_previous")
def tx3(spark: SparkSession, d: str) -> DataFrame:
    return map_text(trims(spark, d).filter("prev_text is not null"), M.trim_after, ["text", "prev_text"])


@query("tx5_loop_removal")
def tx5(spark: SparkSession, d: str) -> DataFrame:
    return map_text(segments(spark, d, "text").filter("text is not null"), M.without_loops, ["text"])


@query("tx6_repeated_sentences")
def tx6(spark: SparkSession, d: str) -> DataFrame:
    return map_text(segments(spark, d, "text").filter("text is not null"), M.without_repeated_sentences, ["text"])


@query("mg1_corrupted_gaps")
def mg1(spark: SparkSession, d: str) -> DataFrame:
    """Segments from gaps and whether they say again what the five texts before them said."""
    r = with_running_sum(segments(spark, d, "text", "from_gap").filter("text is not null"), "file_id", ORDER, F.lit(1), "rn")
    back = r.filter("from_gap").select("file_id", "seg_id", F.col("text").alias("gap"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("k"), "rn")
    back = back.withColumn("rn", F.col("rn") - F.col("k")).join(r.select("file_id", "rn", "text"), ["file_id", "rn"])
    told = back.groupBy("seg_id").agg(F.first("gap").alias("gap"), F.array_join(F.array_sort(F.collect_list(F.struct("rn", "text")))["text"], " ").alias("before"))
    return map_text(told, lambda a, b: M.corrupted(a, [b]), ["gap", "before"], "corrupted", Y.BooleanType())


@query("tx9_full_clean")
def tx9(spark: SparkSession, d: str) -> DataFrame:
    """TX9 and TX10: leadings, repeated sentences and endings off every text; texts of which nothing is left are dropped."""
    return map_text(segments(spark, d, "text").filter("text is not null"), M.cleaned, ["text"]).filter("text <> ''")


@query("ex4_ex6_timestamps")
def ex4(spark: SparkSession, d: str) -> DataFrame:
    """Merged replicas longer than 30 s with clock marks put in."""
    r = wn8(spark, d).filter("end_us - start_us > 30000000").withColumn("subs", F.to_json("sub_segments"))
    put = lambda t, s, e, x: M.with_timestamps(t, int(s), int(e), [(m["start_us"], m["end_us"], m["words"]) for m in json.loads(x)])
    return map_text(r, put, ["text", "start_us", "end_us", "subs"])


@query("jn10_bilingual")
def jn10(spark: SparkSession, d: str) -> DataFrame:
    b = txt_blocks(read(spark, d, "documents").filter("doc_kind = 'narration'")).filter("section is not null")
    b = b.join(read(spark, d, "documents").select("doc_id", F.lower(F.substring(F.trim("lang"), 1, 2)).alias("lang")).distinct(), "doc_id").filter("lang in ('de', 'ru')")
    b = b.select(F.split("section", " ")[0].alias("part"), "sec", F.when(F.col("lang") == "ru", 1).otherwise(0).alias("side")).distinct()
    r = folds.fold(b, ["part"], ["side", "sec"], folds.align_section, "part string, de_sec double, ru_sec double")
    return r.select("part", F.col("de_sec").cast("long"), F.col("ru_sec").cast("long"))


# pages ------------------------------------------------------------------------------------------------------------


def page_terms(df: DataFrame) -> DataFrame:
    """page_id, kind, pos, term: texts of headings, paragraphs, items, cells and links of a page, in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tapeloom.functions.markup import elements

        for b in batches:
            rows = [(p, k, i, t) for p, h in zip(b["page_id"], b["html"], strict=True) for i, (k, t) in enumerate(elements(h))]
            yield pd.DataFrame(rows, columns=["page_id", "kind", "pos", "term"])

    return df.select("page_id", "html").mapInPandas(run, "page_id bigint, kind string, pos int, term string")


@query("voc1b_element_terms")
def voc1b(spark: SparkSession, d: str) -> DataFrame:
    return page_terms(pages(spark, d)).filter("kind in ('p', 'li', 'td', 'th', 'h2', 'h3') and length(term) between 3 and 80 and size(split(term, ' ')) <= 6").select("page_id", "pos", "term")


@query("voc1c_combined_terms")
def voc1c(spark: SparkSession, d: str) -> DataFrame:
    """Links first, then elements, each term once without regard to case."""
    r = page_terms(pages(spark, d)).filter("length(term) between 3 and 80").withColumn("first", F.when(F.col("kind") == "a", 0).otherwise(1))
    return r.groupBy("page_id", F.lower("term").alias("low")).agg(F.min_by("term", F.struct("first", "pos")).alias("term"), F.min("first").alias("from_element"))


@query("voc2a_authors")
def voc2a(spark: SparkSession, d: str) -> DataFrame:
    """Authors of pages: author lines, and what stands before a dash in the title or in the first headings, if it looks like a person."""
    lines = page_terms(pages(spark, d))
    named = lines.filter(F.col("kind").isin("h4", "author", "center", "i") & F.col("term").rlike(r"^[А-ЯЁA-Z][\p{L}]+ [А-ЯЁA-Z]\.$")).select("page_id", F.col("term").alias("author"))
    heads = lines.filter(F.col("kind").isin("h1", "h2")).groupBy("page_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "term"))), 1, 3).alias("h")).select("page_id", F.explode("h.term").alias("x"))
    titles = pages(spark, d).select("page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("x"))
    first = titles.unionByName(heads).select("page_id", V.clean_term(F.split("x", r"\s+[-–—]\s+")[0]).alias("author"))
    return named.unionByName(first.filter((F.col("author") != "") & V.looks_like_person(F.col("author")))).distinct()


@query("voc2b_contents")
def voc2b(spark: SparkSession, d: str) -> DataFrame:
    r = page_terms(pages(spark, d)).filter("kind = 'a' and length(term) >= 4")
    return r.select("page_id", "pos", F.regexp_replace("term", r"^(?:Глава\s+)?[IVX\d]+[.)]\s*", "").alias("term"))


# What a book's text is searched for; ranks are those of the lexicon, in any case.
_RANK = "|".join(f"(?iu:{r})" for r in X.RANKS)
PATTERNS = {
    "rank": (rf"((?:{_RANK})(?:-\p{{Ll}}+)?\p{{Ll}}* \p{{Lu}}\p{{Ll}}+)", 1),
    "quoted": (r"«([^»]{3,60})»", 1),
    "unit": (r"(\d+-\p{Ll}+ (?:\p{Ll}+ ){0,3}(?:дивизи|бригад|полк|батальон|рот|арми|корпус|фронт|флот)\p{Ll}*)", 1),
    "capital": (r"(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+){1,4})", 1),
}


def pattern_terms(df: DataFrame, column: str) -> DataFrame:
    """VOC2g: df with family, place and term of every hit in a text, ranks and units brought back to the nominative."""
    one = lambda k, p, g: F.transform(F.regexp_extract_all(F.col(column), F.lit(p), g), lambda x, i: F.struct(F.lit(k).alias("family"), i.alias("place"), x.alias("term")))
    r = df.withColumn("_hit", F.explode(F.concat(*[one(k, p, g) for k, (p, g) in PATTERNS.items()]))).drop(column)
    term = F.col("_hit.term")
    return r.select("*", "_hit.family", "_hit.place", F.when(F.col("_hit.family").isin("rank", "unit"), V.normalize_case(term)).otherwise(term).alias("term")).drop("_hit")


def page_text() -> Column:
    """The visible text of html: scripts, styles and tags out, character entities of blanks as blanks."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    return F.regexp_replace(bare, r"(?U)(?:&nbsp;|\s)+", " ")


@query("voc2g_all_patterns")
def voc2g(spark: SparkSession, d: str) -> DataFrame:
    """How often each term of each family stands in documents and pages."""
    r = read(spark, d, "documents").filter("text is not null").select("text").unionByName(pages(spark, d).select(page_text().alias("text")))
    return pattern_terms(r, "text").groupBy("family", "term").agg(F.count(F.lit(1)).alias("n"))


@query("voc2h_book_crawl")
def voc2h(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, low, term): the terms of a book: contents and authors of its index page, then what the patterns find in its first fifteen chapters; each term once without regard to case, the first place first.

    An index page is one with links to chapters; links are resolved against its address and joined with the pages that have it."""
    from tapeloom.plans.vocabulary import links

    at = F.regexp_extract("url", r"^(https?://[^/]+(?:/[^?#]*/)?)", 1)
    out = links(spark, d).filter(~F.col("href").rlike("^(#|mailto:|https?:|javascript:)") & F.regexp_extract("href", "([^/]*)$", 1).rlike("(?i)" + X.CHAPTER_LINK))
    out = out.withColumn("target", F.when(F.startswith("href", F.lit("/")), F.concat(F.regexp_extract("url", r"^(https?://[^/]+)", 1), "href")).otherwise(F.concat(at, "href")))
    # links of a page are what its html holds, so this window is as small as a page
    first = out.groupBy("page_id", "target").agg(F.min("pos").alias("pos")).withColumn("chapter", F.row_number().over(W.partitionBy("page_id").orderBy("pos"))).filter("chapter <= 15")
    held = pages(spark, d).join(read(spark, d, "rkka").select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("target")), "page_id").groupBy("target").agg(F.max_by("html", "page_id").alias("html"))
    chapters = pattern_terms(first.join(held, "target").select("page_id", "chapter", page_text().alias("text")), "text")
    books = first.select("page_id").distinct()
    own = voc2a(spark, d).select("page_id", F.lit("author").alias("family"), F.lit(0).alias("place"), F.col("author").alias("term"))
    own = own.unionByName(voc2b(spark, d).select("page_id", F.lit("contents").alias("family"), F.col("pos").cast("int").alias("place"), "term")).join(books, "page_id", "left_semi").withColumn("chapter", F.lit(0))
    every = own.unionByName(chapters.select("page_id", "family", "place", "term", "chapter"))
    return every.filter("term <> ''").groupBy("page_id", F.lower("term").alias("low")).agg(F.min_by("term", F.struct("chapter", "family", "place", "term")).alias("term"))


@query("voc3b_link_texts")
def voc3b(spark: SparkSession, d: str) -> DataFrame:
    return page_terms(pages(spark, d)).filter(F.col("kind").eqNullSafe("a") & (F.length("term") >= 4) & F.col("term").rlike("[А-ЯЁа-яё]")).select("page_id", "pos", "term")


@query("voc3c_page_terms")
def voc3c(spark: SparkSession, d: str) -> DataFrame:
    return page_terms(pages(spark, d)).filter("kind = 'td' and length(term) between 3 and 80").select("page_id", "term").distinct()


@query("src11_cached_fetch")
def src11(spark: SparkSession, d: str) -> DataFrame:
    """Addresses answered from the cache table by their key, the newest copy of each; what it lacks is left to a fetcher."""
    r = read(spark, d, "rkka").filter("url is not null")
    return r.groupBy(F.md5("url").alias("key")).agg(F.max_by("page_id", "fetched_at").alias("page_id"), F.count(F.lit(1)).alias("copies"))
