"""Interval, window and join queries over segments (WN, JN, AG1-AG6, EX, DD)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tapeloom.functions import lexicon as X
from tapeloom.functions.text import any_hit, hms, n_words, sql_any
from tapeloom.operators.intervals import gaps, periods
from tapeloom.operators.ordered import chunked, interval_join, with_islands, with_last, with_neighbours, with_running_sum
from tapeloom.operators.prefix import prefixed
from tapeloom.plans.base import ORDER, SEG, TURNS, W_FILE, read, segments, turns

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: str = ""):  # noqa: ANN201
    def keep(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {', '.join(x for x in (SEG, base) if x)} {sql}"
        return f

    return keep


def pairs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return with_neighbours(segments(spark, d, *columns), "file_id", ORDER, ["seg_id", "start_us", "end_us", *columns])


NEXT = f"nb AS (SELECT *, lag(seg_id) OVER w AS p_id, lag(end_us) OVER w AS p_end, lag(speaker) OVER w AS p_spk, lead(seg_id) OVER w AS n_id, lead(start_us) OVER w AS n_start, lead(end_us) OVER w AS n_end, lead(speaker) OVER w AS n_spk, lead(text) OVER w AS n_text FROM seg WINDOW w AS {W_FILE})"


@query("wn1_gap_detector", "SELECT file_id, p_end AS gap_start_us, start_us AS gap_end_us, round((start_us - p_end) / 1e6, 1) AS duration FROM nb WHERE start_us - p_end > 3000000", NEXT)
def wn1(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d).filter("start_us - prev_end_us > 3000000")
    return r.select("file_id", F.col("prev_end_us").alias("gap_start_us"), F.col("start_us").alias("gap_end_us"), F.round((F.col("start_us") - F.col("prev_end_us")) / 1e6, 1).alias("duration"))


@query("dd8_gaps_without_inverted", f"SELECT file_id, p AS gap_start_us, start_us AS gap_end_us FROM (SELECT *, lag(end_us) OVER {W_FILE} AS p FROM seg WHERE end_us >= start_us) WHERE start_us - p > 3000000")
def dd8(spark: SparkSession, d: str) -> DataFrame:
    r = with_neighbours(segments(spark, d).filter("end_us >= start_us"), "file_id", ORDER, ["end_us"], after=None).filter("start_us - prev_end_us > 3000000")
    return r.select("file_id", F.col("prev_end_us").alias("gap_start_us"), F.col("start_us").alias("gap_end_us"))


@query("wn2_drift_correction", "SELECT seg_id, CASE WHEN start_us - p_end BETWEEN -10000000 AND 0 THEN p_end ELSE start_us END AS start_us, end_us, coalesce(start_us - p_end > 0 AND start_us - p_end <= 500000, false) AS skipped FROM nb", NEXT)
def wn2(spark: SparkSession, d: str) -> DataFrame:
    gap = F.col("start_us") - F.col("prev_end_us")
    r = pairs(spark, d)
    return r.select("seg_id", F.when(gap.between(-10_000_000, 0), F.col("prev_end_us")).otherwise(F.col("start_us")).alias("start_us"), "end_us", F.coalesce((gap > 0) & (gap <= 500_000), F.lit(False)).alias("skipped"))


SHORT = "CASE WHEN p_spk IS NULL OR n_spk IS NULL THEN speaker WHEN end_us - start_us < 1000000 AND nw < 5 AND n_end - n_start > 5000000 AND n_spk <> speaker THEN n_spk WHEN end_us - start_us < 3000000 AND p_spk = n_spk AND p_spk <> speaker THEN p_spk ELSE speaker END"


@query("wn3_context_speaker_single_pass", f"SELECT seg_id, {SHORT} AS speaker FROM (SELECT *, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '')) AS nw FROM nb)", NEXT)
def wn3(spark: SparkSession, d: str) -> DataFrame:
    """The one-pass form: a neighbour counts with the label it came with."""
    r = pairs(spark, d, "speaker", "text").withColumn("nw", n_words(F.regexp_replace(F.coalesce("text", F.lit("")), " ", "x")))
    cur, p, n = F.col("speaker"), F.col("prev_speaker"), F.col("next_speaker")
    dur = F.col("end_us") - F.col("start_us")
    fixed = F.when(p.isNull() | n.isNull(), cur).when((dur < 1_000_000) & (F.col("nw") < 5) & (F.col("next_end_us") - F.col("next_start_us") > 5_000_000) & (n != cur), n).when((dur < 3_000_000) & (p == n) & (p != cur), p).otherwise(cur)
    return r.select("seg_id", fixed.alias("speaker"))


@query("wn4_adjacent_same_speaker", "SELECT file_id, seg_id, n_id AS next_seg_id, speaker, round((n_start - end_us) / 1e6, 2) AS pause, right(coalesce(text, ''), 80) AS tail FROM nb WHERE n_spk = speaker AND speaker <> 'Журналист'", NEXT)
def wn4(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker", "text").filter("next_speaker = speaker and speaker <> 'Журналист'")
    return r.select("file_id", "seg_id", F.col("next_seg_id"), "speaker", F.round((F.col("next_start_us") - F.col("end_us")) / 1e6, 2).alias("pause"), F.expr("right(coalesce(text, ''), 80)").alias("tail"))


@query("wn10_adjacent_any_speaker", "SELECT file_id, count(*) AS n_pairs, count(*) FILTER (WHERE speaker = 'Журналист') AS n_journalist FROM nb WHERE n_spk = speaker GROUP BY file_id", NEXT)
def wn10(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker").filter("next_speaker = speaker")
    return r.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.col("speaker") == "Журналист").alias("n_journalist"))


@query("wn11_pauses_over_three_seconds", "SELECT file_id, seg_id, n_id AS next_seg_id, n_start - end_us AS pause_us FROM nb WHERE n_start - end_us > 3000000", NEXT)
def wn11(spark: SparkSession, d: str) -> DataFrame:
    return pairs(spark, d).filter("next_start_us - end_us > 3000000").select("file_id", "seg_id", "next_seg_id", (F.col("next_start_us") - F.col("end_us")).alias("pause_us"))


@query("wn13_sandwiched_fragments", "SELECT seg_id, p_spk AS around, speaker FROM nb WHERE p_spk = n_spk AND p_spk <> speaker AND end_us - start_us < 2000000", NEXT)
def wn13(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker").filter("prev_speaker = next_speaker and prev_speaker <> speaker and end_us - start_us < 2000000")
    return r.select("seg_id", F.col("prev_speaker").alias("around"), "speaker")


RUNS = f"ru AS (SELECT *, sum(b) OVER {W_FILE} AS run FROM (SELECT *, CASE WHEN lag(speaker) OVER {W_FILE} = speaker THEN 0 ELSE 1 END AS b FROM seg))"


def speaker_runs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return with_islands(segments(spark, d, "speaker", *columns), "file_id", ORDER, ["speaker"], F.coalesce(F.col("prev_speaker") != F.col("speaker"), F.lit(True)), "run")


@query("wn5_monologue_to_date", "SELECT seg_id, end_us - first_value(start_us) OVER (PARTITION BY file_id, run ORDER BY start_us, seg_id) AS monologue_us FROM ru", RUNS)
def wn5(spark: SparkSession, d: str) -> DataFrame:
    r = speaker_runs(spark, d)
    first = r.groupBy("file_id", "run").agg(F.min("start_us").alias("first_us"))
    return r.join(first, ["file_id", "run"]).select("seg_id", (F.col("end_us") - F.col("first_us")).alias("monologue_us"))


@query("wn6_inside_long_monologue", "SELECT seg_id, l - f > 60000000 AS inside FROM (SELECT seg_id, min(start_us) OVER p AS f, last_value(end_us) OVER (PARTITION BY file_id, run ORDER BY start_us, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM ru WINDOW p AS (PARTITION BY file_id, run))", RUNS)
def wn6(spark: SparkSession, d: str) -> DataFrame:
    r = speaker_runs(spark, d)
    span = r.groupBy("file_id", "run").agg(F.min("start_us").alias("f"), F.max_by("end_us", F.struct(*ORDER)).alias("l"))
    return r.join(span, ["file_id", "run"]).select("seg_id", (F.col("l") - F.col("f") > 60_000_000).alias("inside"))


AUTO = f"au AS (SELECT *, sum(b) OVER {W_FILE} AS g FROM (SELECT *, CASE WHEN lag(speaker) OVER {W_FILE} = speaker AND speaker <> 'Оператор' AND (lag(raw_speaker_id) OVER {W_FILE} = raw_speaker_id) AND start_us - lag(end_us) OVER {W_FILE} < 5000000 THEN 0 ELSE 1 END AS b FROM seg))"


def islands_of(r: DataFrame, merge) -> DataFrame:  # noqa: ANN001
    return with_islands(r, "file_id", ORDER, ["speaker", "raw_speaker_id", "end_us"], ~F.coalesce(merge, F.lit(False)), "g")


def merged(r: DataFrame) -> DataFrame:
    at = F.struct(*ORDER)
    return r.groupBy("file_id", "g").agg(
        F.min("start_us").alias("start_us"), F.max_by("end_us", at).alias("end_us"), F.min_by("speaker", at).alias("speaker"), F.min_by("raw_speaker_id", at).alias("raw_speaker_id"), F.count(F.lit(1)).cast("int").alias("n"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*ORDER, F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), " ").alias("text"),
    )


MERGED = "SELECT file_id, min(start_us) AS start_us, arg_max(end_us, (start_us, seg_id)) AS end_us, arg_min(speaker, (start_us, seg_id)) AS speaker, arg_min(raw_speaker_id, (start_us, seg_id)) AS raw_speaker_id, CAST(count(*) AS INTEGER) AS n, string_agg(coalesce(text, ''), ' ' ORDER BY start_us, seg_id) AS text"


@query("wn7_auto_merge_adjacent", MERGED + " FROM au GROUP BY file_id, g", AUTO)
def wn7(spark: SparkSession, d: str) -> DataFrame:
    """Islands of one speaker and one raw label with pauses below 5 s; a chain compares each row with the one before."""
    same = (F.col("prev_speaker") == F.col("speaker")) & (F.col("speaker") != "Оператор") & (F.col("prev_raw_speaker_id") == F.col("raw_speaker_id"))
    r = islands_of(segments(spark, d, "speaker", "raw_speaker_id", "text"), same & (F.col("start_us") - F.col("prev_end_us") < 5_000_000))
    return merged(r).drop("g")


REPL = f"re AS (SELECT *, sum(b) OVER {W_FILE} AS g FROM (SELECT *, CASE WHEN lag(speaker) OVER {W_FILE} = speaker AND start_us - lag(end_us) OVER {W_FILE} BETWEEN -2000000 AND CASE WHEN speaker = 'Журналист' THEN 3000000 ELSE 2000000 END THEN 0 ELSE 1 END AS b FROM seg WHERE end_us >= start_us))"


def replicas(spark: SparkSession, d: str) -> DataFrame:
    pause = F.col("start_us") - F.col("prev_end_us")
    join = (F.col("prev_speaker") == F.col("speaker")) & pause.between(F.lit(-2_000_000), F.when(F.col("speaker") == "Журналист", 3_000_000).otherwise(2_000_000))
    return merged(islands_of(segments(spark, d, "speaker", "raw_speaker_id", "text").filter("end_us >= start_us"), join))


HMS = "format('{:02d}:{:02d}:{:02d}', CAST(floor(start_us / 1e6) AS BIGINT) // 3600, (CAST(floor(start_us / 1e6) AS BIGINT) % 3600) // 60, CAST(floor(start_us / 1e6) AS BIGINT) % 60)"


@query("wn8_replica_islands", f"SELECT *, {HMS} AS time_hms FROM ({MERGED} FROM re GROUP BY file_id, g)", REPL)
def wn8(spark: SparkSession, d: str) -> DataFrame:
    """The merge by speaker and pause alone, with clock times; wn8_replica_merge has the whole state machine."""
    return replicas(spark, d).drop("g").withColumn("time_hms", hms(F.col("start_us")))


@query("ag5_replica_provenance", "SELECT file_id, min(start_us) AS start_us, first(confidence ORDER BY start_us, seg_id) AS confidence, arg_max(speaker, (length(coalesce(text, '')), -start_us, -seg_id)) AS speaker, list({'start_us': start_us, 'end_us': end_us} ORDER BY start_us, seg_id) AS sub_segments FROM re GROUP BY file_id, g", REPL)
def ag5(spark: SparkSession, d: str) -> DataFrame:
    """First start and confidence, the label of the longest member, and the members as nested provenance."""
    pause = F.col("start_us") - F.col("prev_end_us")
    join = (F.col("prev_speaker") == F.col("speaker")) & pause.between(F.lit(-2_000_000), F.when(F.col("speaker") == "Журналист", 3_000_000).otherwise(2_000_000))
    r = islands_of(segments(spark, d, "speaker", "raw_speaker_id", "text", "confidence").filter("end_us >= start_us"), join)
    subs = F.transform(F.sort_array(F.collect_list(F.struct("start_us", "seg_id", "end_us"))), lambda x: F.struct(x["start_us"].alias("start_us"), x["end_us"].alias("end_us")))
    longest = F.struct(F.length(F.coalesce("text", F.lit(""))), -F.col("start_us"), -F.col("seg_id"))
    at = F.struct(*ORDER)
    return r.groupBy("file_id", "g").agg(F.min("start_us").alias("start_us"), F.min_by("confidence", at).alias("confidence"), F.max_by("speaker", longest).alias("speaker"), subs.alias("sub_segments")).drop("g")


def first_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first n rows of each key in ORDER: first those of each chunk of a key, then of what the chunks have left."""
    w = W.partitionBy(*keys, "_c").orderBy(*ORDER)
    few = chunked(df, ORDER[0]).withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n)
    # chunks after the first n of a key can hold none of its first rows
    rank = few.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_k"))
    rank = prefixed(rank, keys, "_c", {"_before": ("sum", "_k")}).filter(F.col("_before") < n).drop("_k")
    return few.join(rank, [*keys, "_c"]).filter(F.col("_before") + F.col("_n") <= n).drop("_c", "_n", "_before")


@query("wn14_first_ten_per_speaker", "SELECT file_id, speaker, seg_id FROM seg QUALIFY row_number() OVER (PARTITION BY file_id, speaker ORDER BY start_us, seg_id) <= 10")
def wn14(spark: SparkSession, d: str) -> DataFrame:
    return first_rows(segments(spark, d, "speaker"), ["file_id", "speaker"], 10).select("file_id", "speaker", "seg_id")


@query("wn15_last_known_raw_label", f"SELECT seg_id, last_value(nullif(raw_speaker_id, '') IGNORE NULLS) OVER (PARTITION BY file_id ORDER BY start_us, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_label FROM seg")
def wn15(spark: SparkSession, d: str) -> DataFrame:
    r = segments(spark, d, "raw_speaker_id")
    return with_last(r, "file_id", ORDER, F.nullif("raw_speaker_id", F.lit("")), "last_label").select("seg_id", "last_label")


@query("wn16_announcement_neighbours", f"SELECT seg_id, {sql_any('lower(trim(n_text))', X.CONFIRMATION)} AS confirmed FROM nb WHERE {sql_any('lower(text)', X.ANNOUNCEMENT)} AND len(list_filter(string_split(text, ' '), lambda x: x <> '')) < {X.ANNOUNCEMENT_WORDS} AND n_text IS NOT NULL", NEXT)
def wn16(spark: SparkSession, d: str) -> DataFrame:
    """Announcements of a question and whether the next row confirms them."""
    said = any_hit(F.lower("text"), X.ANNOUNCEMENT) & (F.size(F.filter(F.split("text", " "), lambda x: x != "")) < X.ANNOUNCEMENT_WORDS)
    r = pairs(spark, d, "text").filter(said & F.col("next_text").isNotNull())
    return r.select("seg_id", any_hit(F.lower(F.trim("next_text")), X.CONFIRMATION).alias("confirmed"))


# joins ------------------------------------------------------------------------------------------------------------


def overlaps(spark: SparkSession, d: str) -> DataFrame:
    left = segments(spark, d).filter("end_us > start_us").select("file_id", "seg_id", F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    right = turns(spark, d).select("file_id", "turn_id", "label", F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"))
    pairs_ = interval_join(left, right, "file_id").filter("seg_id <> turn_id")
    return pairs_.withColumn("ov", F.least("l_end", "r_end") - F.greatest("l_start", "r_start"))


OVER = "ov AS (SELECT s.file_id, s.seg_id, s.start_us AS l_start, s.end_us AS l_end, t.turn_id, t.label, t.start_us AS r_start, t.end_us AS r_end, least(s.end_us, t.end_us) - greatest(s.start_us, t.start_us) AS ov FROM seg s JOIN turns t ON s.file_id = t.file_id AND t.start_us < s.end_us AND s.start_us < t.end_us AND s.seg_id <> t.turn_id WHERE s.end_us > s.start_us)"
DOM = "SELECT seg_id, label, ov, round(100.0 * ov / (l_end - l_start), 6) AS coverage_pct FROM (SELECT seg_id, label, CAST(sum(ov) AS BIGINT) AS ov, min((r_start, turn_id)) AS f, min(l_start) AS l_start, min(l_end) AS l_end FROM ov GROUP BY seg_id, label) QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY ov DESC, f) = 1"


def dominant(spark: SparkSession, d: str) -> DataFrame:
    by = overlaps(spark, d).groupBy("file_id", "seg_id", "label").agg(F.sum("ov").alias("ov"), F.min(F.struct("r_start", "turn_id")).alias("f"), F.min("l_start").alias("l_start"), F.min("l_end").alias("l_end"))
    best = F.struct("ov", (-F.col("f.r_start")).alias("a"), (-F.col("f.turn_id")).alias("b"))
    return by.groupBy("file_id", "seg_id").agg(F.max_by("label", best).alias("label"), F.max("ov").alias("ov"), F.min("l_start").alias("l_start"), F.min("l_end").alias("l_end"))


@query("jn1_dominant_overlap", DOM, f"{TURNS}, {OVER}")
def jn1(spark: SparkSession, d: str) -> DataFrame:
    return dominant(spark, d).select("seg_id", "label", "ov", F.round(100.0 * F.col("ov") / (F.col("l_end") - F.col("l_start")), 6).alias("coverage_pct"))


ROLES = "ro AS (SELECT file_id, tape_no, label, max(role_name) AS role FROM speaker_roles GROUP BY file_id, tape_no, label)"


def tape_roles(spark: SparkSession, d: str) -> DataFrame:
    """Whose voice a label is on each tape: labels may change hands between the tapes of a recording."""
    return read(spark, d, "speaker_roles").groupBy("file_id", "tape_no", "label").agg(F.max("role_name").alias("role"))


@query("jn2_align_with_carry", f"SELECT s.seg_id, coalesce(do_.label, last_value(do_.label IGNORE NULLS) OVER (PARTITION BY s.file_id ORDER BY s.start_us, s.seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'UNKNOWN') AS label FROM seg s LEFT JOIN (SELECT seg_id AS sid, label FROM ({DOM})) do_ ON s.seg_id = do_.sid", f"{TURNS}, {OVER}")
def jn2(spark: SparkSession, d: str) -> DataFrame:
    """Left outer: a segment that no turn overlaps takes the label before it, the first ones UNKNOWN."""
    r = segments(spark, d).join(dominant(spark, d).select("seg_id", "label"), "seg_id", "left")
    return with_last(r, "file_id", ORDER, F.col("label"), "before").select("seg_id", F.coalesce("label", "before", F.lit("UNKNOWN")).alias("label"))


@query("jn4_dominant_role", f"SELECT x.seg_id, coalesce(ro.role, x.label) AS role FROM ({DOM}) x JOIN seg USING (seg_id) LEFT JOIN ro ON ro.file_id = seg.file_id AND ro.tape_no = seg.tape_no AND ro.label = x.label WHERE x.ov > 1000000", f"{TURNS}, {OVER}, {ROLES}")
def jn4(spark: SparkSession, d: str) -> DataFrame:
    """The role, on the segment's own tape, of the label that most of a segment's time overlaps, for more than a second."""
    r = dominant(spark, d).filter("ov > 1000000").join(segments(spark, d, "tape_no").select("seg_id", "tape_no"), "seg_id")
    r = r.join(tape_roles(spark, d), ["file_id", "tape_no", "label"], "left")
    return r.select("seg_id", F.coalesce("role", "label").alias("role"))


ASOF = "gp AS (SELECT file_id, p_end AS gs, start_us AS ge FROM nb WHERE start_us - p_end > 3000000)"


@query("jn5_neighbours_of_gaps", "SELECT file_id, gs AS gap_start_us, ge AS gap_end_us, p_spk AS prev_speaker, speaker AS next_speaker FROM (SELECT file_id, p_end AS gs, start_us AS ge, p_spk, speaker FROM nb WHERE start_us - p_end > 3000000)", NEXT)
def jn5(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker").filter("start_us - prev_end_us > 3000000")
    return r.select("file_id", F.col("prev_end_us").alias("gap_start_us"), F.col("start_us").alias("gap_end_us"), "prev_speaker", F.col("speaker").alias("next_speaker"))


DECIDE = "CASE WHEN p_spk = speaker THEN speaker WHEN p_spk = 'Журналист' THEN CASE WHEN start_us - p_end > 15000000 THEN a.surname ELSE 'Журналист' END WHEN p_spk = a.surname OR speaker = a.surname THEN a.surname ELSE 'Неизвестно' END"


@query("jn6_gap_speaker_decision", f"SELECT nb.file_id, p_end AS gap_start_us, {DECIDE} AS speaker FROM nb JOIN (SELECT file_id, max(surname) AS surname FROM audio_files GROUP BY file_id) a ON a.file_id = nb.file_id WHERE start_us - p_end > 3000000", NEXT)
def jn6(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker").filter("start_us - prev_end_us > 3000000").join(read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname")), "file_id")
    p, n, s = F.col("prev_speaker"), F.col("speaker"), F.col("surname")
    who = F.when(p == n, n).when(p == "Журналист", F.when(F.col("start_us") - F.col("prev_end_us") > 15_000_000, s).otherwise("Журналист")).when((p == s) | (n == s), s).otherwise("Неизвестно")
    return r.select("file_id", F.col("prev_end_us").alias("gap_start_us"), who.alias("speaker"))


@query("jn7_coverage_by_others", "SELECT s.seg_id, CASE WHEN s.end_us <= s.start_us THEN 100.0 ELSE round(100.0 * coalesce(sum(ov), 0) / (s.end_us - s.start_us), 6) END AS coverage_pct FROM seg s LEFT JOIN ov ON ov.seg_id = s.seg_id GROUP BY s.seg_id, s.start_us, s.end_us", f"{TURNS}, {OVER}")
def jn7(spark: SparkSession, d: str) -> DataFrame:
    r = segments(spark, d).join(overlaps(spark, d).groupBy("seg_id").agg(F.sum("ov").alias("ov")), "seg_id", "left")
    pct = F.round(100.0 * F.coalesce("ov", F.lit(0)) / F.nullif(F.col("end_us") - F.col("start_us"), F.lit(0)), 6)
    return r.select("seg_id", F.when(F.col("end_us") <= F.col("start_us"), 100.0).otherwise(pct).alias("coverage_pct"))


@query("jn9_roles_both_ways", f"SELECT s.seg_id, ro.role, rv.label AS label_of_speaker FROM seg s LEFT JOIN ro ON ro.file_id = s.file_id AND ro.tape_no = s.tape_no AND ro.label = s.raw_speaker_id LEFT JOIN (SELECT file_id, tape_no, role, max(label) AS label FROM ro GROUP BY file_id, tape_no, role) rv ON rv.file_id = s.file_id AND rv.tape_no = s.tape_no AND rv.role = s.speaker", ROLES)
def jn9(spark: SparkSession, d: str) -> DataFrame:
    """On each tape, the role of a segment's label and the label (the last of several) of its speaker."""
    ro = tape_roles(spark, d)
    r = segments(spark, d, "tape_no", "speaker", "raw_speaker_id").join(ro.withColumnRenamed("label", "raw_speaker_id"), ["file_id", "tape_no", "raw_speaker_id"], "left")
    return r.join(label_of(spark, d), ["file_id", "tape_no", "speaker"], "left").select("seg_id", "role", "label_of_speaker")


def label_of(spark: SparkSession, d: str) -> DataFrame:
    return tape_roles(spark, d).groupBy("file_id", "tape_no", F.col("role").alias("speaker")).agg(F.max("label").alias("label_of_speaker"))


# aggregations -----------------------------------------------------------------------------------------------------


@query("ag1_speaking_time", "SELECT file_id, label, CAST(sum(end_us - start_us) AS BIGINT) AS talk_us FROM turns GROUP BY file_id, label", TURNS)
def ag1(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).groupBy("file_id", "label").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("talk_us"))


@query("ag2_audio_duration", "SELECT file_id, max(end_us) AS duration_us FROM turns GROUP BY file_id", TURNS)
def ag2(spark: SparkSession, d: str) -> DataFrame:
    return turns(spark, d).groupBy("file_id").agg(F.max("end_us").alias("duration_us"))


RANK = "tt AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY t DESC, label) AS rk, count(*) OVER (PARTITION BY file_id) AS n FROM (SELECT file_id, label, sum(end_us - start_us) AS t FROM turns GROUP BY file_id, label))"
#: The closing word border, spelled out for an engine whose own knows ASCII only.
_JOURNALIST_SQL = X.JOURNALIST_FIRST.replace(r"\b", r"(?:$|[^\p{L}\p{N}_])")
FIRST = f"fs AS (SELECT file_id, raw_speaker_id AS label, CAST(sum(CASE WHEN rn <= 10 AND {sql_any('lower(text)', [X.OPERATOR_FIRST])} THEN 3 ELSE 0 END) AS BIGINT) AS operator_score, CAST(sum(CASE WHEN rn <= 10 AND {sql_any('lower(text)', [_JOURNALIST_SQL])} THEN 2 ELSE 0 END) AS BIGINT) AS journalist_score, min(start_us) < 30000000 AS early, count(*) AS n_segments FROM (SELECT *, row_number() OVER (PARTITION BY file_id, raw_speaker_id ORDER BY start_us, seg_id) AS rn FROM seg WHERE raw_speaker_id <> '') GROUP BY file_id, raw_speaker_id)"


@query("ag4_first_ten_evidence", "SELECT * FROM fs", FIRST)
def ag4(spark: SparkSession, d: str) -> DataFrame:
    """Of each raw label: how its first ten segments sound, whether it speaks in the first 30 s, and how many segments it has."""
    r = segments(spark, d, "raw_speaker_id", "text").filter("raw_speaker_id <> ''").withColumnRenamed("raw_speaker_id", "label")
    sounds = lambda p, n: F.sum(F.when(any_hit(F.lower("text"), [p]), n).otherwise(0))
    first = first_rows(r, ["file_id", "label"], 10).groupBy("file_id", "label").agg(sounds(X.OPERATOR_FIRST, 3).alias("operator_score"), sounds(X.JOURNALIST_FIRST, 2).alias("journalist_score"))
    all_ = r.groupBy("file_id", "label").agg((F.min("start_us") < 30_000_000).alias("early"), F.count(F.lit(1)).alias("n_segments"))
    return first.join(all_, ["file_id", "label"]).select("file_id", "label", "operator_score", "journalist_score", "early", "n_segments")


LIKELY = "lk AS (SELECT tt.*, CASE WHEN rk > 1 THEN (CASE WHEN coalesce(talk_us / CAST(n_segments AS DOUBLE), 0) < 5000000 THEN 3 ELSE 0 END) + coalesce(operator_score, 0) + (CASE WHEN coalesce(early, false) THEN 2 ELSE 0 END) + (CASE WHEN talk_us < 15000000 THEN 2 ELSE 0 END) END AS likelihood FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY talk_us DESC, label) AS rk, count(*) OVER (PARTITION BY file_id) AS n FROM (SELECT file_id, label, CAST(sum(end_us - start_us) AS BIGINT) AS talk_us FROM turns GROUP BY file_id, label)) tt LEFT JOIN fs ON fs.file_id = tt.file_id AND fs.label = tt.label)"


@query("ag3_role_assignment", "SELECT lk.file_id, lk.label, CASE WHEN rk = 1 THEN surname WHEN n >= 3 AND likelihood > 5 AND row_number() OVER (PARTITION BY lk.file_id ORDER BY likelihood DESC NULLS LAST, rk) = 1 THEN 'Оператор' ELSE 'Журналист' END AS role FROM lk JOIN (SELECT file_id, max(surname) AS surname FROM audio_files GROUP BY file_id) a ON a.file_id = lk.file_id WHERE n >= 2", f"{TURNS}, {FIRST}, {LIKELY}")
def ag3(spark: SparkSession, d: str) -> DataFrame:
    """By talk time the first label is the expert's.  Of three or more, the most likely of the others is the operator's, if likely enough; the rest are journalists.  One label alone gets no role.

    Short segments on the average, an operator's words, an early start and little talk speak for an operator.  Labels of a recording are few, so these windows are small."""
    w = W.partitionBy("file_id")
    r = ag1(spark, d).withColumns({"rk": F.row_number().over(w.orderBy(F.desc("talk_us"), "label")), "n": F.count(F.lit(1)).over(w)}).filter("n >= 2")
    r = r.join(ag4(spark, d), ["file_id", "label"], "left").join(read(spark, d, "audio_files").groupBy("file_id").agg(F.max("surname").alias("surname")), "file_id")
    points = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    short = F.coalesce(F.col("talk_us") / F.col("n_segments"), F.lit(0.0)) < 5_000_000
    likelihood = F.when(F.col("rk") > 1, points(short, 3) + F.coalesce("operator_score", F.lit(0)) + points(F.col("early"), 2) + points(F.col("talk_us") < 15_000_000, 2))
    r = r.withColumn("likelihood", likelihood)
    best = F.row_number().over(w.orderBy(F.desc_nulls_last("likelihood"), "rk")) == 1
    r = r.withColumn("best", best)
    return r.select("file_id", "label", F.when(F.col("rk") == 1, F.col("surname")).when((F.col("n") >= 3) & (F.col("likelihood") > 5) & F.col("best"), "Оператор").otherwise("Журналист").alias("role"))


@query("ag6_validation_report", "SELECT file_id, count(*) FILTER (WHERE n_spk = speaker AND speaker <> 'Журналист') AS n_adjacent, count(*) FILTER (WHERE n_id IS NOT NULL AND end_us - start_us < 2000000 AND speaker <> 'Журналист') AS n_short, count(*) FILTER (WHERE n_start - end_us > 10000000) AS n_pauses FROM nb GROUP BY file_id", NEXT)
def ag6(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker")
    c = lambda e: F.count_if(F.expr(e))
    return r.groupBy("file_id").agg(c("next_speaker = speaker and speaker <> 'Журналист'").alias("n_adjacent"), c("next_seg_id is not null and end_us - start_us < 2000000 and speaker <> 'Журналист'").alias("n_short"), c("next_start_us - end_us > 10000000").alias("n_pauses"))


@query("ag13_label_transitions", "SELECT p_spk AS from_speaker, speaker AS to_speaker, count(*) AS n FROM nb WHERE p_spk IS NOT NULL AND p_spk <> speaker GROUP BY ALL", NEXT)
def ag13(spark: SparkSession, d: str) -> DataFrame:
    r = pairs(spark, d, "speaker").filter("prev_speaker is not null and prev_speaker <> speaker")
    return r.groupBy(F.col("prev_speaker").alias("from_speaker"), F.col("speaker").alias("to_speaker")).agg(F.count(F.lit(1)).alias("n"))


@query("ag14_run_stats", "SELECT count(DISTINCT file_id) AS files, count(*) AS n_segments, count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS empty, count(*) FILTER (WHERE from_gap) AS from_gap FROM seg")
def ag14(spark: SparkSession, d: str) -> DataFrame:
    r = segments(spark, d, "text", "from_gap")
    return r.agg(F.count_distinct("file_id").alias("files"), F.count(F.lit(1)).alias("n_segments"), F.count_if(F.expr("text is null or trim(text) = ''")).alias("empty"), F.count_if("from_gap").alias("from_gap"))


# generators -------------------------------------------------------------------------------------------------------

SENT = r"se AS (SELECT seg_id, start_us, end_us, i - 1 AS pos, p[i] AS sentence FROM (SELECT *, list_filter(regexp_split_to_array(trim(text), '[.!?]+\s+'), lambda x: x <> '') AS p FROM seg WHERE text IS NOT NULL AND end_us > start_us), LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i))"


def sentences(spark: SparkSession, d: str) -> DataFrame:
    r = segments(spark, d, "text").filter("text is not null and end_us > start_us")
    return r.select("seg_id", "start_us", "end_us", F.posexplode(F.filter(F.split(F.trim("text"), r"[.!?]+\s+"), lambda x: x != "")).alias("pos", "sentence"))


@query("ex9_sentences", "SELECT seg_id, CAST(pos AS INTEGER) AS pos, sentence FROM se", SENT)
def ex9(spark: SparkSession, d: str) -> DataFrame:
    return sentences(spark, d).select("seg_id", "pos", "sentence")


@query("ex2_split_by_words", r"SELECT seg_id, CAST(pos AS INTEGER) AS pos, CAST(floor(start_us + (end_us - start_us) * ((cum - w) / CAST(tot AS DOUBLE))) AS BIGINT) AS s_us, CAST(floor(start_us + (end_us - start_us) * (cum / CAST(tot AS DOUBLE))) AS BIGINT) AS e_us FROM (SELECT *, sum(w) OVER (PARTITION BY seg_id ORDER BY pos) AS cum, sum(w) OVER (PARTITION BY seg_id) AS tot FROM (SELECT *, len(list_filter(regexp_split_to_array(sentence, ' '), lambda x: x <> '')) AS w FROM se)) WHERE tot > 0", SENT)
def ex2(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of a replica with their share of its time by words."""
    return _timed(sentences(spark, d).withColumn("w", F.size(F.filter(F.split("sentence", " "), lambda x: x != "")).cast("long")))


@query("ex3_split_by_characters", "SELECT seg_id, CAST(pos AS INTEGER) AS pos, CAST(floor(start_us + (end_us - start_us) * ((cum - w) / CAST(tot AS DOUBLE))) AS BIGINT) AS s_us, CAST(floor(start_us + (end_us - start_us) * (cum / CAST(tot AS DOUBLE))) AS BIGINT) AS e_us FROM (SELECT *, sum(w) OVER (PARTITION BY seg_id ORDER BY pos) AS cum, sum(w) OVER (PARTITION BY seg_id) AS tot FROM (SELECT *, length(sentence) AS w FROM se)) WHERE tot > 0", SENT)
def ex3(spark: SparkSession, d: str) -> DataFrame:
    return _timed(sentences(spark, d).withColumn("w", F.length("sentence").cast("long")))


def _timed(r: DataFrame) -> DataFrame:
    w = W.partitionBy("seg_id")
    r = r.withColumns({"cum": F.sum("w").over(w.orderBy("pos")), "tot": F.sum("w").over(w)}).filter("tot > 0")
    at = lambda c: F.floor(F.col("start_us") + (F.col("end_us") - F.col("start_us")) * (c / F.col("tot").cast("double"))).cast("long")
    return r.select("seg_id", "pos", at(F.col("cum") - F.col("w")).alias("s_us"), at(F.col("cum")).alias("e_us"))


@query("ex5_word_to_time", "SELECT seg_id, CAST(floor(s + (e - s) * 0.5) AS BIGINT) AS mid_us FROM (SELECT seg_id, sub_segments[1].start_us AS s, sub_segments[1].end_us AS e, row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC NULLS LAST, sub_segments[1].start_us DESC NULLS LAST, sub_segments[1].end_us DESC NULLS LAST) AS rn FROM segments_merged WHERE seg_id IS NOT NULL) WHERE rn = 1 AND s IS NOT NULL AND e IS NOT NULL")
def ex5(spark: SparkSession, d: str) -> DataFrame:
    """The time of the middle word of the first member, by linear interpolation inside its sub-segment."""
    r = read(spark, d, "segments_merged").filter("seg_id is not null")
    r = r.select("seg_id", "loaded_at", F.get("sub_segments", F.lit(0)).alias("x"))
    r = r.groupBy("seg_id").agg(F.max(F.struct("loaded_at", "x.start_us", "x.end_us")).alias("x")).filter("x.start_us is not null and x.end_us is not null")
    return r.select("seg_id", F.floor(F.col("x.start_us") + (F.col("x.end_us") - F.col("x.start_us")) * 0.5).cast("long").alias("mid_us"))


STAMP = r"'\d{2}:\d{2}:\d{2}'"


@query("ex7_split_by_inner_timestamps", f"SELECT seg_id, CAST(i - 1 AS INTEGER) AS pos, trim(p[i]) AS part, CASE WHEN i = 1 THEN NULL ELSE t[i - 1] END AS ts FROM (SELECT seg_id, regexp_split_to_array(text, {STAMP}) AS p, regexp_extract_all(text, {STAMP}) AS t FROM seg WHERE regexp_matches(text, {STAMP})), LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i) WHERE trim(p[i]) <> ''")
def ex7(spark: SparkSession, d: str) -> DataFrame:
    pat = r"\d{2}:\d{2}:\d{2}"
    r = segments(spark, d, "text").filter(F.col("text").rlike(pat)).select("seg_id", F.expr(rf"regexp_extract_all(text, '\\d{{2}}:\\d{{2}}:\\d{{2}}', 0)").alias("t"), F.posexplode(F.split("text", pat)).alias("pos", "part"))
    return r.select("seg_id", "pos", F.trim("part").alias("part"), F.when(F.col("pos") > 0, F.get("t", F.col("pos") - 1)).alias("ts")).filter("part <> ''")


@query("ex8_long_turn_windows", "SELECT turn_id, start_us + k * 9000000 AS s_us, least(start_us + k * 9000000 + 12000000, end_us) AS e_us FROM turns, LATERAL (SELECT unnest(range(0, CASE WHEN end_us - start_us <= 12000000 THEN 1 ELSE CAST(floor((end_us - start_us - 1) / 9000000) AS BIGINT) + 1 END)) AS k)", TURNS)
def ex8(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 12 s every 9 s over turns longer than 12 s."""
    last = F.when(F.expr("end_us - start_us <= 12000000"), F.lit(0)).otherwise(F.expr("(end_us - start_us - 1) div 9000000"))
    r = turns(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    return r.select("turn_id", F.expr("start_us + k * 9000000").alias("s_us"), F.expr("least(start_us + k * 9000000 + 12000000, end_us)").alias("e_us"))


@query("wn12_timestamp_gaps_in_text", f"SELECT doc_id, count(*) AS n_stamps, CAST(max(sec - p) AS BIGINT) AS longest_s, CAST(sum(CASE WHEN sec - p > 30 THEN 1 ELSE 0 END) AS BIGINT) AS n_gaps FROM (SELECT doc_id, sec, lag(sec) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM (SELECT doc_id, i, CAST(t[i][1:2] AS BIGINT) * 3600 + CAST(t[i][4:5] AS BIGINT) * 60 + CAST(t[i][7:8] AS BIGINT) AS sec FROM (SELECT doc_id, regexp_extract_all(text, {STAMP}) AS t FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(t) + 1)) AS i))) GROUP BY doc_id")
def wn12(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "documents").filter("text is not null").select("doc_id", F.posexplode(F.expr(r"regexp_extract_all(text, '\\d{2}:\\d{2}:\\d{2}', 0)")).alias("i", "t"))
    sec = F.expr("cast(substr(t, 1, 2) as bigint) * 3600 + cast(substr(t, 4, 2) as bigint) * 60 + cast(substr(t, 7, 2) as bigint)")
    r = r.withColumn("sec", sec).withColumn("gap", F.col("sec") - F.lag("sec").over(W.partitionBy("doc_id").orderBy("i")))
    return r.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_stamps"), F.max("gap").alias("longest_s"), F.count_if(F.col("gap") > 30).alias("n_gaps"))


# deduplication in its exact forms ---------------------------------------------------------------------------------

RN = f"rn AS (SELECT *, row_number() OVER {W_FILE} AS rn, lower(trim(text)) AS t FROM seg WHERE text IS NOT NULL AND trim(text) <> '')"


def numbered(spark: SparkSession, d: str) -> DataFrame:
    r = segments(spark, d, "speaker", "text").filter("text is not null and trim(text) <> ''").withColumn("t", F.lower(F.trim("text")))
    return with_running_sum(r, "file_id", ORDER, F.lit(1), "rn")


@query("dd1_cross_speaker_exact", "SELECT a.seg_id AS seg_a, b.seg_id AS seg_b FROM rn a JOIN rn b ON a.file_id = b.file_id AND a.t = b.t AND a.speaker <> b.speaker AND b.rn BETWEEN a.rn + 1 AND a.rn + 9 AND b.start_us - a.start_us < 5000000", RN)
def dd1(spark: SparkSession, d: str) -> DataFrame:
    """Equal texts of two speakers within nine rows and 5 s; the time bin makes it an equi join."""
    return _close(numbered(spark, d), 9).filter("a_speaker <> b_speaker and b_start - a_start < 5000000").select("seg_a", "seg_b")


def _close(r: DataFrame, n: int) -> DataFrame:
    """Pairs of equal text at most n rows apart: each row meets the row number bins of n rows it can reach."""
    a = r.select("file_id", "t", F.col("rn").alias("ra"), F.col("seg_id").alias("seg_a"), F.col("speaker").alias("a_speaker"), F.col("start_us").alias("a_start"), F.explode(F.array(F.expr(f"rn div {n}"), F.expr(f"rn div {n} + 1"))).alias("bin"))
    b = r.select("file_id", "t", F.col("rn").alias("rb"), F.col("seg_id").alias("seg_b"), F.col("speaker").alias("b_speaker"), F.col("start_us").alias("b_start"), F.expr(f"rn div {n}").alias("bin"))
    return a.join(b, ["file_id", "t", "bin"]).filter(f"rb between ra + 1 and ra + {n}")


@query("dd2_same_speaker_exact", "SELECT a.seg_id AS seg_a, b.seg_id AS seg_b FROM rn a JOIN rn b ON a.file_id = b.file_id AND a.t = b.t AND a.speaker = b.speaker AND b.rn BETWEEN a.rn + 1 AND a.rn + 10", RN)
def dd2(spark: SparkSession, d: str) -> DataFrame:
    return _close(numbered(spark, d), 10).filter("a_speaker = b_speaker").select("seg_a", "seg_b")


@query("qa5_checkpoint_covering", "SELECT file_id, min(seg_id) AS first_seg, count(*) AS n FROM seg WHERE start_us <= 60000000 AND end_us > 60000000 GROUP BY file_id")
def qa5(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d).filter("start_us <= 60000000 and end_us > 60000000").groupBy("file_id").agg(F.min("seg_id").alias("first_seg"), F.count(F.lit(1)).alias("n"))


@query("sort_talk_time_rank", "SELECT file_id, label, CAST(rk AS INTEGER) AS rk FROM tt", f"{TURNS}, {RANK}")
def talk_rank(spark: SparkSession, d: str) -> DataFrame:
    return ag1(spark, d).select("file_id", "label", F.row_number().over(W.partitionBy("file_id").orderBy(F.desc("talk_us"), "label")).alias("rk"))


@query("continuous_periods_by_raw_label", "SELECT file_id, label, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY file_id, label ORDER BY start_us, turn_id) AS g FROM (SELECT *, CASE WHEN start_us <= max(end_us) OVER (PARTITION BY file_id, label ORDER BY start_us, turn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS b FROM turns)) GROUP BY file_id, label, g", TURNS)
def label_periods(spark: SparkSession, d: str) -> DataFrame:
    return periods(turns(spark, d), ["file_id", "label"])


@query("silences_of_recordings", "SELECT file_id, p AS start_us, start_us AS end_us FROM (SELECT *, max(end_us) OVER (PARTITION BY file_id ORDER BY start_us, seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM seg WHERE end_us >= start_us) WHERE start_us - p > 3000000 AND start_us - p <= 600000000")
def silences(spark: SparkSession, d: str) -> DataFrame:
    return gaps(segments(spark, d), ["file_id"], longer_than_us=3_000_000, at_most_us=600_000_000)


@query("qa5_checkpoints_by_minute", "SELECT file_id, m AS minute, arg_min(seg_id, (start_us, seg_id)) AS first_seg, count(*) AS n FROM (SELECT *, unnest(range(CAST(ceil(start_us / 60e6) AS BIGINT), CAST(floor((end_us - 1) / 60e6) AS BIGINT) + 1)) AS m FROM seg WHERE end_us > start_us) GROUP BY file_id, m")
def qa5_minutes(spark: SparkSession, d: str) -> DataFrame:
    """At every full minute of a recording: the first segment that covers it (its start counts, its end does not), and how many do."""
    r = segments(spark, d).filter("end_us > start_us").withColumns({"a": F.ceil(F.col("start_us") / 60e6).cast("long"), "b": F.floor((F.col("end_us") - 1) / 60e6).cast("long")}).filter("a <= b")
    r = r.withColumn("minute", F.explode(F.sequence("a", "b")))
    return r.groupBy("file_id", "minute").agg(F.min_by("seg_id", F.struct(*ORDER)).alias("first_seg"), F.count(F.lit(1)).alias("n"))
