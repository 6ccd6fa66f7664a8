"""Text predicates, scores, cleaning and checks over segments and documents (PRD, CL, TX, QA, MG2, SRC6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tapeloom.functions import lexicon as X
from tapeloom.functions.text import any_hit, hit, re2
from tapeloom.plans.base import ORDER, SEG, W_FILE, read, segments

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: str = ""):  # noqa: ANN201
    def keep(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {', '.join(x for x in (SEG, base) if x)} {sql}"
        return f

    return keep


def one(p: str, c: str = "t") -> str:
    return f"regexp_matches({c}, '{re2(p)}')"


def some(ps: list[str], c: str = "t") -> str:
    return "(" + " OR ".join(one(p, c) for p in ps) + ")"


TXT = "tx AS (SELECT seg_id, file_id, start_us, end_us, speaker, text, confidence, lower(text) AS t, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS nw FROM seg WHERE text IS NOT NULL)"


def texts(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    r = segments(spark, d, "text", *columns).filter("text is not null")
    return r.withColumns({"t": F.lower("text"), "nw": F.size(F.filter(F.split("text", " "), lambda x: x != "")).cast("long")})


def T() -> Column:  # noqa: N802 - the text in lower case
    return F.col("t")


def journalist(t: Column, words: Column) -> Column:
    """PRD1: quotations rule it out, strong marks decide, weak ones only in short context."""
    return F.when(any_hit(t, X.QUOTATION), False).when(any_hit(t, X.STRONG), True).when(words > X.CONTEXT_WORDS, False).otherwise(any_hit(t, X.WEAK))


J_SQL = f"CASE WHEN {some(X.QUOTATION)} THEN false WHEN {some(X.STRONG)} THEN true WHEN nw > {X.CONTEXT_WORDS} THEN false ELSE {some(X.WEAK)} END"


@query("prd1_journalist_phrase", f"SELECT seg_id, {J_SQL} AS is_journalist FROM tx", TXT)
def prd1(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("seg_id", journalist(T(), F.col("nw")).alias("is_journalist"))


@query("prd2_expert_phrase", f"SELECT tx.seg_id, contains(t, lower(surname)) OR {some(X.EXPERT)} AS is_expert FROM tx JOIN (SELECT file_id, max(surname) AS surname FROM audio_files GROUP BY file_id) a ON a.file_id = tx.file_id", TXT)
def prd2(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    return texts(spark, d).join(a, "file_id").select("seg_id", (F.contains(T(), F.lower("surname")) | any_hit(T(), X.EXPERT)).alias("is_expert"))


def flag(name: str, column: str, ps: list[str], short: bool = False) -> None:
    extra = f" AND nw < {X.ANNOUNCEMENT_WORDS}" if short else ""

    @query(name, f"SELECT seg_id, {some(ps)}{extra} AS {column} FROM tx", TXT)
    def run(spark: SparkSession, d: str) -> DataFrame:
        e = any_hit(T(), ps)
        return texts(spark, d).select("seg_id", (e & (F.col("nw") < X.ANNOUNCEMENT_WORDS) if short else e).alias(column))


flag("prd3_continuation_split", "continues", X.CONTINUATION_SPLIT)
flag("prd4_continuation_classify", "continues", X.CONTINUATION_CLASSIFY)
flag("prd5_question_announcement", "announces", X.ANNOUNCEMENT, short=True)
flag("prd5b_question_announcement_wide", "announces", X.ANNOUNCEMENT_WIDE, short=True)
flag("prd6_journalist_command", "commands", X.COMMANDS)
flag("prd7_question_segment", "asks", X.QUESTION)
flag("prd8_confirmation", "confirms", X.CONFIRMATION)
flag("prd12b_monologue_marks", "monologue", [p for s, p, w in X.SCORES if s == "s" and w > 0])


@query("prd9_hallucination", r"SELECT seg_id, length(trim(c)) < 3 OR len(list_distinct(string_split(lower(c), ''))) < 3 AS invented FROM (SELECT seg_id, regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g') AS c FROM tx)", TXT)
def prd9(spark: SparkSession, d: str) -> DataFrame:
    r = texts(spark, d).withColumn("c", F.regexp_replace("text", r"[^\p{L}\p{N}_\s]", ""))
    return r.select("seg_id", ((F.length(F.trim("c")) < 3) | (F.size(F.array_distinct(F.split(F.lower("c"), ""))) < 3)).alias("invented"))


N_SENT = "len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: trim(x) <> ''))"


def n_sentences(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "[.!?]+"), lambda x: F.trim(x) != "")).cast("long")


@query("prd10_suspicious", f"SELECT seg_id, CASE WHEN confidence IS NULL OR confidence >= -0.20 THEN '' WHEN nw <= 5 THEN 'micro' WHEN {N_SENT} >= 3 THEN 'merged' ELSE '' END AS reason FROM tx", TXT)
def prd10(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("confidence")
    return texts(spark, d, "confidence").select("seg_id", F.when(c.isNull() | (c >= -0.20), "").when(F.col("nw") <= 5, "micro").when(n_sentences(F.col("text")) >= 3, "merged").otherwise("").alias("reason"))


@query("prd11_sentence_count", f"SELECT seg_id, {N_SENT} AS n FROM tx", TXT)
def prd11(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("seg_id", n_sentences(F.col("text")).alias("n"))


@query("prd12a_addressing_speaker", f"SELECT seg_id, nw < 15 AND {some(X.COMMANDS)} AND NOT {some([p for s, p, w in X.SCORES if s == 's' and w > 0])} AS addresses FROM tx", TXT)
def prd12a(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("seg_id", ((F.col("nw") < 15) & any_hit(T(), X.COMMANDS) & ~any_hit(T(), [p for s, p, w in X.SCORES if s == "s" and w > 0])).alias("addresses"))


@query("prd14_vad_threshold", "SELECT file_id, tape_no, CASE WHEN duration_us < 300000000 THEN 0.65 WHEN duration_us < 600000000 THEN 0.70 WHEN duration_us < 900000000 THEN 0.75 ELSE 0.80 END::DOUBLE AS threshold, vad_threshold FROM audio_files WHERE duration_us IS NOT NULL")
def prd14(spark: SparkSession, d: str) -> DataFrame:
    e = F
    for s, v in X.VAD_STEPS:
        e = e.when(F.col("duration_us") < s * 1_000_000, float(v))
    return read(spark, d, "audio_files").filter("duration_us is not null").select("file_id", "tape_no", e.otherwise(0.80).alias("threshold"), "vad_threshold")


@query("prd15_parse_file_name", "SELECT filename, regexp_extract(filename, '^([^_]+)_(.+)_([0-9]+)\\.wav', 2) AS speaker, regexp_extract(filename, '^([^_]+)_(.+)_([0-9]+)\\.wav', 3) AS part FROM audio_files WHERE filename IS NOT NULL")
def prd15(spark: SparkSession, d: str) -> DataFrame:
    p = r"^([^_]+)_(.+)_([0-9]+)\.wav"
    return read(spark, d, "audio_files").filter("filename is not null").select("filename", F.regexp_extract("filename", p, 2).alias("speaker"), F.regexp_extract("filename", p, 3).alias("part"))


# scores -----------------------------------------------------------------------------------------------------------


def score(side: str) -> Column:
    e, t = F.lit(0), T()
    for s, p, w in X.SCORES:
        if s == side:
            e = e + F.when(hit(t, p), w).otherwise(0)
    return e.cast("int")


def score_sql(side: str) -> str:
    return "CAST(" + " + ".join(f"CASE WHEN {one(p)} THEN {w} ELSE 0 END" for s, p, w in X.SCORES if s == side) + " AS INTEGER)"


@query("cl0_weighted_scores", f"SELECT seg_id, {score_sql('j')} AS journalist, {score_sql('s')} AS expert FROM tx", TXT)
def cl0(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("seg_id", score("j").alias("journalist"), score("s").alias("expert"))


FLIP = f"fl AS (SELECT tx.*, surname, {score_sql('j')} AS j, {score_sql('s')} AS s FROM tx JOIN (SELECT file_id, max(surname) AS surname FROM audio_files GROUP BY file_id) a ON a.file_id = tx.file_id)"


@query("cl1_score_flips", "SELECT seg_id, CASE WHEN nw < 5 OR speaker = 'Оператор' THEN speaker WHEN speaker = surname AND j - s > 3 THEN 'Журналист' WHEN speaker = 'Журналист' AND s - j > 3 THEN surname ELSE speaker END AS speaker FROM fl", f"{TXT}, {FLIP}")
def cl1(spark: SparkSession, d: str) -> DataFrame:
    """The flips of the classification pass, which need no state; cl1_classification has the pass with its memory."""
    a = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    r = texts(spark, d, "speaker").join(a, "file_id").withColumns({"j": score("j"), "s": score("s")})
    who, diff = F.col("speaker"), F.col("j") - F.col("s")
    flips = F.when((F.col("nw") < 5) | (who == "Оператор"), who).when((who == F.col("surname")) & (diff > X.FLIP_DIFFERENCE), "Журналист").when((who == "Журналист") & (-diff > X.FLIP_DIFFERENCE), F.col("surname")).otherwise(who)
    return r.select("seg_id", flips.alias("speaker"))


INTRO = f"""nr AS (SELECT seg.*, surname, lower(coalesce(text, '')) AS t, len(list_filter(string_split(coalesce(text, ''), ' '), lambda x: x <> '')) AS nw, row_number() OVER {W_FILE} AS rn, lower(trim(lead(coalesce(text, '')) OVER {W_FILE})) AS nt, CASE WHEN lag(speaker) OVER {W_FILE} = speaker THEN 0 ELSE 1 END AS b
 FROM seg JOIN (SELECT file_id, max(surname) AS surname FROM audio_files GROUP BY file_id) USING (file_id)),
 ns AS (SELECT *, sum(b) OVER {W_FILE} AS run FROM nr),
 nm AS (SELECT *, min(start_us) OVER (PARTITION BY file_id, run) AS f, last_value(end_us) OVER (PARTITION BY file_id, run ORDER BY start_us, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM ns)"""
SPARED = f"rn <= 2 OR {some(X.COMMANDS)} OR {some(X.QUESTION)} OR l - f > 60000000 OR ({some(X.ANNOUNCEMENT)} AND nw < {X.ANNOUNCEMENT_WORDS} AND coalesce({some(X.CONFIRMATION, 'nt')}, false))"


@query("cl2_text_correction", f"SELECT seg_id, CASE WHEN speaker <> surname AND NOT ({SPARED}) AND (contains(t, lower(surname)) OR {some(X.INTRODUCTION)}) THEN surname ELSE speaker END AS speaker FROM nm", INTRO)
def cl2(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    r = segments(spark, d, "speaker", "text").withColumn("text", F.coalesce("text", F.lit(""))).join(a, "file_id")
    return introduced(r).select("seg_id", "speaker")


def introduced(r: DataFrame) -> DataFrame:
    """CL2 on (file_id, seg_id, start_us, end_us, speaker, surname, text), other columns carried along.

    Who introduces themselves as the expert is the expert, but for the first two rows, commands, questions, rows inside a run of more than 60 s, and announcements that the next row confirms.
    Runs are taken before the pass changes any speaker."""
    from tapeloom.operators.ordered import with_islands, with_neighbours, with_running_sum

    own = r.columns
    r = with_running_sum(with_neighbours(r, "file_id", ORDER, ["text"], before=None), "file_id", ORDER, F.lit(1), "rn")
    r = with_islands(r, "file_id", ORDER, ["speaker"], F.coalesce(F.col("prev_speaker") != F.col("speaker"), F.lit(True)), "run")
    span = r.groupBy("file_id", "run").agg((F.max_by("end_us", F.struct(*ORDER)) - F.min("start_us") > 60_000_000).alias("inside"))
    r = r.join(span, ["file_id", "run"]).withColumns({"t": F.lower("text"), "nw": F.size(F.filter(F.split("text", " "), lambda x: x != ""))})
    confirmed = any_hit(T(), X.ANNOUNCEMENT) & (F.col("nw") < X.ANNOUNCEMENT_WORDS) & F.coalesce(any_hit(F.lower(F.trim("next_text")), X.CONFIRMATION), F.lit(False))
    spared = (F.col("rn") <= 2) | any_hit(T(), X.COMMANDS) | any_hit(T(), X.QUESTION) | F.col("inside") | confirmed
    named = F.contains(T(), F.lower("surname")) | any_hit(T(), X.INTRODUCTION)
    return r.withColumn("speaker", F.when((F.col("speaker") != F.col("surname")) & ~spared & named, F.col("surname")).otherwise(F.col("speaker"))).select(*own)


def _place(pattern: str) -> str:
    """Where a pattern between word borders begins in t, null where it does not stand."""
    out = r"[^\p{L}\p{N}_]"
    core = rf"(?s)^((?:.*?{out})??)(?:{pattern.replace(chr(92) + 'b', '')})(?:$|{out})"
    return f"CASE WHEN regexp_matches(t, '{core}') THEN length(regexp_extract(t, '{core}', 1)) + 1 END"


_AROUND = "CASE WHEN len(list_filter(string_split(substr(text, 1, p{0} - 1), ' '), lambda x: x <> '')) > 3 AND len(list_filter(string_split(substr(text, p{0}), ' '), lambda x: x <> '')) > 3 THEN p{0} END"
COMMAND_AT = f"cm AS (SELECT *, coalesce({', '.join(_AROUND.format(i) for i in range(len(X.SPLIT_COMMANDS)))}) AS p FROM (SELECT seg.*, lower(text) AS t, {', '.join(f'{_place(q)} AS p{i}' for i, q in enumerate(X.SPLIT_COMMANDS))} FROM seg JOIN (SELECT file_id, max(surname) AS surname FROM audio_files GROUP BY file_id) USING (file_id) WHERE text IS NOT NULL AND speaker = surname))"


@query("ex1_command_split", "SELECT seg_id, CAST(part AS INTEGER) AS part, CASE WHEN part = 1 THEN speaker ELSE 'Журналист' END AS speaker, CASE WHEN part = 1 THEN raw_speaker_id ELSE 'JOURNALIST_COMMAND' END AS raw_speaker_id, CASE WHEN part = 1 THEN start_us ELSE start_us + CAST(floor((end_us - start_us) / 2.0) AS BIGINT) END AS start_us, CASE WHEN part = 1 THEN start_us + CAST(floor((end_us - start_us) / 2.0) AS BIGINT) ELSE end_us END AS end_us, CASE WHEN part = 1 THEN trim(substr(text, 1, p - 1)) ELSE trim(substr(text, p)) END AS text FROM cm, (SELECT unnest([1, 2]) AS part) WHERE p IS NOT NULL", COMMAND_AT)
def ex1(spark: SparkSession, d: str) -> DataFrame:
    """The two halves of the expert's replicas that hold a command of the journalist with more than three words on both sides; they meet at the middle of its time."""
    a = read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname"))
    r = segments(spark, d, "speaker", "raw_speaker_id", "text").filter("text is not null").join(a, "file_id").filter("speaker = surname")
    return command_halves(r)


def command_halves(r: DataFrame, others: list[str] | None = None) -> DataFrame:
    """EX1 on rows of the expert (seg_id, start_us, end_us, speaker, raw_speaker_id, text): the halves of those that are split."""
    n = lambda c: F.size(F.filter(F.split(c, " "), lambda x: x != ""))
    low = F.lower("text")
    # the first command in the order of the list that has words enough around it
    at = []
    for p in X.SPLIT_COMMANDS:
        k = F.when(hit(low, p), F.length(F.regexp_extract(low, "(?isuU)^(.*?)" + p, 1)) + 1)
        at.append(F.when((n(F.substring("text", F.lit(1), k - 1)) > 3) & (n(F.substring("text", k, F.length("text"))) > 3), k))
    r = r.withColumn("p", F.coalesce(*at)).filter("p is not null").withColumn("part", F.explode(F.array(F.lit(1), F.lit(2))))
    first, mid = F.col("part") == 1, F.col("start_us") + F.floor((F.col("end_us") - F.col("start_us")) / 2.0).cast("long")
    return r.select(
        "seg_id", *(others or []), "part", F.when(first, F.col("speaker")).otherwise("Журналист").alias("speaker"), F.when(first, F.col("raw_speaker_id")).otherwise("JOURNALIST_COMMAND").alias("raw_speaker_id"),
        F.when(first, F.col("start_us")).otherwise(mid).alias("start_us"), F.when(first, mid).otherwise(F.col("end_us")).alias("end_us"),
        F.trim(F.when(first, F.substring("text", F.lit(1), F.col("p") - 1)).otherwise(F.substring("text", F.col("p"), F.length("text")))).alias("text"),
    )


# cleaning ---------------------------------------------------------------------------------------------------------


def drop_ending(text: Column) -> Column:
    """TX7: the first ending that fits is taken off, then no other."""
    e = F
    for p in X.ENDINGS:
        e = e.when(hit(text, p), F.trim(F.regexp_replace(text, "(?iuU)" + p, "")))
    return e.otherwise(text)


def drop_leading(text: Column) -> Column:
    """TX8: all leadings are taken off, one after the other."""
    for p in X.LEADINGS:
        text = F.trim(F.regexp_replace(text, "(?iuU)" + p, ""))
    return text


NOISY = "nz AS (SELECT seg_id, CASE WHEN seg_id % 3 = 0 THEN text || ' Спасибо за внимание!' WHEN seg_id % 3 = 1 THEN 'Untertitel von Test. ' || text ELSE text END AS x FROM tx)"


def noisy(spark: SparkSession, d: str) -> DataFrame:
    """Every text, two thirds of them with boilerplate put before or behind it, so that cleaning has work to do."""
    m = F.pmod("seg_id", F.lit(3))
    return texts(spark, d).select("seg_id", F.when(m == 0, F.concat("text", F.lit(" Спасибо за внимание!"))).when(m == 1, F.concat(F.lit("Untertitel von Test. "), "text")).otherwise(F.col("text")).alias("x"))


def end_sql(c: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '(?i){p}') THEN trim(regexp_replace({c}, '(?i){p}', ''))" for p in X.ENDINGS) + f" ELSE {c} END"


def lead_sql(c: str) -> str:
    for p in X.LEADINGS:
        c = f"trim(regexp_replace({c}, '(?i){p}', ''))"
    return c


@query("tx7_ending_boilerplate", f"SELECT seg_id, {end_sql('x')} AS text FROM nz", f"{TXT}, {NOISY}")
def tx7(spark: SparkSession, d: str) -> DataFrame:
    return noisy(spark, d).select("seg_id", drop_ending(F.col("x")).alias("text"))


@query("tx8_leading_boilerplate", f"SELECT seg_id, {lead_sql('x')} AS text FROM nz", f"{TXT}, {NOISY}")
def tx8(spark: SparkSession, d: str) -> DataFrame:
    return noisy(spark, d).select("seg_id", drop_leading(F.col("x")).alias("text"))


@query("tx9_composite_clean", rf"SELECT seg_id, trim(regexp_replace(regexp_replace(c, '\s+', ' ', 'g'), '([.!?])+', '\1', 'g')) AS text FROM (SELECT seg_id, {end_sql('l')} AS c FROM (SELECT seg_id, {lead_sql('x')} AS l FROM nz))", f"{TXT}, {NOISY}")
def tx9(spark: SparkSession, d: str) -> DataFrame:
    """Leading, ending, white space and repeated signs; a run of signs becomes its last one."""
    return noisy(spark, d).withColumn("l", drop_leading(F.col("x"))).withColumn("c", drop_ending(F.col("l"))).select("seg_id", F.trim(F.regexp_replace(F.regexp_replace("c", r"\s+", " "), "([.!?])+", "$1")).alias("text"))


@query("tx10_drop_emptied", r"SELECT count(*) AS n_in, count(*) FILTER (WHERE length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) > 0) AS n_kept FROM tx", TXT)
def tx10(spark: SparkSession, d: str) -> DataFrame:
    kept = F.length(F.regexp_replace("text", r"[^\p{L}\p{N}]", "")) > 0
    return texts(spark, d).agg(F.count(F.lit(1)).alias("n_in"), F.count_if(kept).alias("n_kept"))


@query("tx11_low_confidence_masking", "SELECT seg_id, CASE WHEN confidence < -0.35 THEN array_to_string(list_transform(string_split(text, ' '), lambda x: CASE WHEN length(x) >= 12 THEN '[нрзб]' ELSE x END), ' ') ELSE text END AS text FROM tx WHERE confidence IS NOT NULL", TXT)
def tx11(spark: SparkSession, d: str) -> DataFrame:
    """Long words of doubtful segments become a mark; the data has one confidence for all words of a segment."""
    masked = F.array_join(F.transform(F.split("text", " "), lambda x: F.when(F.length(x) >= 12, "[нрзб]").otherwise(x)), " ")
    return texts(spark, d, "confidence").filter("confidence is not null").select("seg_id", F.when(F.col("confidence") < -0.35, masked).otherwise(F.col("text")).alias("text"))


def mask_words(words: Column, least: float = 0.35, letters: int = 4) -> Column:
    """TX11 on an array of (word, probability): words less sure than ``least``, of ``letters`` or more letters and figures, become a mark, and marks in a row one mark."""
    doubtful = lambda w: F.coalesce(w["probability"] < least, F.lit(False)) & (F.length(F.regexp_replace(w["word"], r"[^\p{L}\p{N}_]", "")) >= letters)
    masked = F.transform(F.filter(words, lambda w: F.coalesce(F.trim(w["word"]), F.lit("")) != ""), lambda w: F.when(doubtful(w), "[нрзб]").otherwise(F.trim(w["word"])))
    # a mark that follows a mark is left out
    kept = F.aggregate(masked, F.array().cast("array<string>"), lambda out, w: F.when((w == "[нрзб]") & F.coalesce(F.try_element_at(out, F.lit(-1)) == "[нрзб]", F.lit(False)), out).otherwise(F.concat(out, F.array(w))))
    return F.array_join(kept, " ")


@query("tx11_mask_words", r"SELECT seg_id, array_to_string([m[i] FOR i IN range(1, len(m) + 1) IF NOT (m[i] = '[нрзб]' AND i > 1 AND coalesce(m[i - 1], '') = '[нрзб]')], ' ') AS text FROM (SELECT seg_id, list_transform(list_filter(string_split(text, ' '), lambda x: trim(x) <> ''), lambda x: CASE WHEN exp(confidence) < 0.35 AND length(regexp_replace(x, '[^\p{L}\p{N}_]', '', 'g')) >= 4 THEN '[нрзб]' ELSE trim(x) END) AS m FROM tx WHERE confidence IS NOT NULL)", TXT)
def tx11_words(spark: SparkSession, d: str) -> DataFrame:
    """Doubtful words masked by their probability; the tables hold only the mean log probability of a segment, so that stands for each of its words."""
    words = F.transform(F.split("text", " "), lambda x: F.struct(x.alias("word"), F.exp("confidence").alias("probability")))
    return texts(spark, d, "confidence").filter("confidence is not null").select("seg_id", mask_words(words).alias("text"))


@query("tx12_strip_timestamps", r"SELECT seg_id, trim(regexp_replace(text, '\s*\d{2}:\d{2}:\d{2}\s*', ' ', 'g')) AS text FROM tx", TXT)
def tx12(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("seg_id", F.trim(F.regexp_replace("text", r"\s*\d{2}:\d{2}:\d{2}\s*", " ")).alias("text"))


PAIR = f"pr AS (SELECT seg_id, text, lead(text) OVER {W_FILE} AS nxt FROM seg WHERE text IS NOT NULL AND trim(text) <> '')"
WORDS4 = r"list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: length(x) >= 4))"


@query("tx4_restart_test", f"SELECT seg_id, len(g) > 0 AND len(list_intersect(g, n)) >= 0.5 * len(g) AS restarts FROM (SELECT seg_id, {WORDS4.format('text')} AS g, {WORDS4.format('nxt')} AS n FROM pr WHERE nxt IS NOT NULL)", PAIR)
def tx4(spark: SparkSession, d: str) -> DataFrame:
    """Half of a text's distinct words of four letters or more return in the next text."""
    from tapeloom.operators.ordered import with_neighbours

    r = segments(spark, d, "text").filter("text is not null and trim(text) <> ''")
    r = with_neighbours(r, "file_id", ORDER, ["text"], before=None).filter("next_text is not null")
    w = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda x: F.length(x) >= 4))
    r = r.withColumns({"g": w("text"), "n": w("next_text")})
    return r.select("seg_id", ((F.size("g") > 0) & (F.size(F.array_intersect("g", "n")) >= 0.5 * F.size("g"))).alias("restarts"))


LIST_STOP = "[" + ", ".join(f"'{w}'" for w in X.MERGE_STOP) + "]"


@query("mg2_meaningful_words", rf"SELECT seg_id, len(list_filter(w, lambda x: NOT list_contains({LIST_STOP}, x))) AS n_weighty, len(list_filter(w, lambda x: length(x) > 3 AND NOT list_contains({LIST_STOP}, x))) AS n_meaningful FROM (SELECT seg_id, list_filter(regexp_split_to_array(regexp_replace(t, '[.,!?;:«»\"''()\[\]]', '', 'g'), '[\s\p{{Z}}]+'), lambda x: x <> '') AS w FROM tx)", TXT)
def mg2(spark: SparkSession, d: str) -> DataFrame:
    """Words that are no stop words of the merge, and those of them longer than three letters."""
    stop = F.array(*[F.lit(w) for w in X.MERGE_STOP])
    w = F.filter(F.split(F.regexp_replace(T(), r"[.,!?;:«»\"'()\[\]]", ""), r"[\s\p{Z}]+"), lambda x: (x != "") & ~F.array_contains(stop, x))
    r = texts(spark, d).withColumn("w", w)
    return r.select("seg_id", F.size("w").cast("long").alias("n_weighty"), F.size(F.filter("w", lambda x: F.length(x) > 3)).cast("long").alias("n_meaningful"))


# checks -----------------------------------------------------------------------------------------------------------


@query("qa1_long_blocks", r"SELECT seg_id, CASE WHEN end_us - start_us > 60000000 THEN 'long' WHEN end_us - start_us > 30000000 THEN 'warn' ELSE 'ok' END AS state FROM tx WHERE NOT regexp_matches(text, '\d{2}:\d{2}:\d{2}')", TXT)
def qa1(spark: SparkSession, d: str) -> DataFrame:
    dur = F.col("end_us") - F.col("start_us")
    return texts(spark, d).filter(~F.col("text").rlike(r"\d{2}:\d{2}:\d{2}")).select("seg_id", F.when(dur > 60_000_000, "long").when(dur > 30_000_000, "warn").otherwise("ok").alias("state"))


@query("qa2_repeated_sentence", r"SELECT DISTINCT doc_id FROM (SELECT doc_id, p[i] AS a, p[i + 1] AS b FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?]\s+') AS p FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(p))) AS i)) WHERE length(a) >= 20 AND starts_with(b, a)")
def qa2(spark: SparkSession, d: str) -> DataFrame:
    """A sentence of 20 characters or more that is said twice in a row."""
    r = read(spark, d, "documents").filter("text is not null").select("doc_id", F.split("text", r"[.!?]\s+").alias("p"))
    twice = F.exists(F.arrays_zip(F.expr("slice(p, 1, size(p) - 1)").alias("a"), F.expr("slice(p, 2, size(p) - 1)").alias("b")), lambda x: (F.length(x["a"]) >= 20) & F.startswith(x["b"], x["a"]))
    return r.filter(F.size("p") > 1).filter(twice).select("doc_id").distinct()


@query("qa3_stuttering", r"SELECT seg_id, count(*) AS n FROM (SELECT seg_id, p[i] AS a, p[i + 1] AS b FROM (SELECT seg_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS p FROM tx), LATERAL (SELECT unnest(range(1, len(p))) AS i)) WHERE a = b AND length(a) >= 3 GROUP BY seg_id", TXT)
def qa3(spark: SparkSession, d: str) -> DataFrame:
    r = texts(spark, d).select("seg_id", F.split(T(), r"[^\p{L}\p{N}]+").alias("p")).filter(F.size("p") > 1)
    z = F.arrays_zip(F.expr("slice(p, 1, size(p) - 1)").alias("a"), F.expr("slice(p, 2, size(p) - 1)").alias("b"))
    return r.select("seg_id", F.size(F.filter(z, lambda x: (x["a"] == x["b"]) & (F.length(x["a"]) >= 3))).cast("long").alias("n")).filter("n > 0")


@query("ag12_phrase_metrics", "SELECT source, CAST(sum(len(regexp_extract_all(text, 'потому что'))) AS BIGINT) AS n_because, count(*) FILTER (WHERE contains(lower(text), 'журнал')) AS n_journal FROM documents WHERE text IS NOT NULL GROUP BY source")
def ag12(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").filter("text is not null").groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("потому что"))).cast("long").alias("n_because"), F.count_if(F.contains(F.lower("text"), F.lit("журнал"))).alias("n_journal"))


BLOCKS = r"""bl AS (SELECT doc_id, i - 1 AS pos, p[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE doc_kind = 'narration' AND text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i)),
 b2 AS (SELECT *, CASE WHEN regexp_matches(line, '^\d{3,}-\d+\s*\([^)]+\)\s*$') THEN trim(line) END AS sec, regexp_extract(line, '^(\d{2}:\d{2}:\d{2}):?\s+(.*)', 1) AS ts, regexp_extract(line, '^(\d{2}:\d{2}:\d{2}):?\s+(.*)', 2) AS body FROM bl)"""


@query("src6_txt_blocks", "SELECT doc_id, section, ts, CAST(ts[1:2] AS BIGINT) * 3600 + CAST(ts[4:5] AS BIGINT) * 60 + CAST(ts[7:8] AS BIGINT) AS sec, body AS text FROM (SELECT doc_id, ts, body, last_value(sec IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM b2) WHERE ts <> ''", BLOCKS)
def src6(spark: SparkSession, d: str) -> DataFrame:
    return txt_blocks(read(spark, d, "documents").filter("doc_kind = 'narration'"))


def txt_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, section, ts, sec, text: the time-coded lines of a text with the section header above them."""
    r = docs.filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    stamp = r"^(\d{2}:\d{2}:\d{2}):?\s+(.*)"
    r = r.withColumns({"h": F.when(F.col("line").rlike(r"^\d{3,}-\d+\s*\([^)]+\)\s*$"), F.trim("line")), "ts": F.regexp_extract("line", stamp, 1), "text": F.regexp_extract("line", stamp, 2)})
    r = r.withColumn("section", F.last("h", ignorenulls=True).over(W.partitionBy("doc_id").orderBy("pos"))).filter("ts <> ''")
    return r.select("doc_id", "section", "ts", F.expr("cast(substr(ts, 1, 2) as bigint) * 3600 + cast(substr(ts, 4, 2) as bigint) * 60 + cast(substr(ts, 7, 2) as bigint)").alias("sec"), "text")


BI = f"{BLOCKS}, bb AS (SELECT DISTINCT lang, section, sec FROM (SELECT d.lang, b.doc_id, section, CAST(ts[1:2] AS BIGINT) * 3600 + CAST(ts[4:5] AS BIGINT) * 60 + CAST(ts[7:8] AS BIGINT) AS sec FROM (SELECT doc_id, ts, last_value(sec IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM b2) b JOIN (SELECT DISTINCT doc_id, lang FROM documents) d ON d.doc_id = b.doc_id WHERE ts <> '') WHERE section IS NOT NULL)"


@query("jn10_bilingual_exact", "SELECT coalesce(a.part, b.part) AS part, coalesce(a.sec, b.sec) AS sec, a.sec IS NOT NULL AS has_de, b.sec IS NOT NULL AS has_ru FROM (SELECT DISTINCT split_part(section, ' ', 1) AS part, sec FROM bb WHERE lower(left(trim(lang), 2)) = 'de') a FULL JOIN (SELECT DISTINCT split_part(section, ' ', 1) AS part, sec FROM bb WHERE lower(left(trim(lang), 2)) = 'ru') b ON a.part = b.part AND a.sec = b.sec", BI)
def jn10(spark: SparkSession, d: str) -> DataFrame:
    """Sections of two languages side by side, joined where their seconds are equal; jn10_bilingual has the tolerance."""
    b = txt_blocks(read(spark, d, "documents").filter("doc_kind = 'narration'")).filter("section is not null")
    b = b.join(read(spark, d, "documents").select("doc_id", F.lower(F.substring(F.trim("lang"), 1, 2)).alias("lang")).distinct(), "doc_id")
    side = lambda x, n: b.filter(F.col("lang") == x).select(F.split("section", " ")[0].alias("part"), "sec").distinct().withColumn(n, F.lit(True))
    return side("de", "has_de").join(side("ru", "has_ru"), ["part", "sec"], "full_outer").select("part", "sec", F.coalesce("has_de", F.lit(False)).alias("has_de"), F.coalesce("has_ru", F.lit(False)).alias("has_ru"))
