"""Vocabulary, addresses, pages, sources, sinks and snapshots (VOC, PRD16-24, AG7-11, AG15, JN11-14, TX13-18, SRC, SNK)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tapeloom.functions import lexicon as X
from tapeloom.functions.text import hms, re2
from tapeloom.operators import vocabulary as V
from tapeloom.operators.term_counts import term_counts
from tapeloom.plans.base import SEG, TERMS, read, segments, terms
from tapeloom.session import cut

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, base: str = ""):  # noqa: ANN201
    def keep(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {base} {sql}" if base else sql
        return f

    return keep


def distinct_terms(spark: SparkSession, d: str) -> DataFrame:
    return V_terms(spark, d).select("term").distinct()


def V_terms(spark: SparkSession, d: str) -> DataFrame:  # noqa: N802
    """Term-list lines, the hot words of vocab and the words of page titles: material that keeps and rejects."""
    own = terms(spark, d).select("term")
    titles = read(spark, d, "rkka").filter("html is not null").select(F.explode(F.split(F.regexp_extract("html", r"<title>([^<]*)</title>", 1), r" — | \| ")).alias("term")).filter("term <> ''")
    return own.unionByName(read(spark, d, "vocab").select("term")).unionByName(titles)


VT = TERMS + r", vt AS (SELECT term FROM terms UNION ALL SELECT term FROM vocab UNION ALL SELECT p[i] AS term FROM (SELECT regexp_split_to_array(regexp_extract(html, '<title>([^<]*)</title>', 1), ' — | \| ') AS p FROM rkka WHERE html IS NOT NULL), LATERAL (SELECT unnest(range(1, len(p) + 1)) AS i) WHERE p[i] <> ''), dt AS (SELECT DISTINCT term FROM vt)"


def per_term(name: str, column: str, expr, sql: str) -> None:  # noqa: ANN001
    @query(name, f"SELECT term, {sql} AS {column} FROM dt", VT)
    def run(spark: SparkSession, d: str) -> DataFrame:
        return distinct_terms(spark, d).select("term", expr(F.col("term")).alias(column))


def m(p: str, c: str = "term") -> str:
    return f"regexp_matches({c}, '{re2(p)}')"


LOWER1 = "lower(string_split(term, ' ')[1])"
NW = "len(string_split(term, ' '))"
per_term("prd18a_useful_latin", "useful", V.useful_latin, r"CASE WHEN NOT regexp_matches(term, '^[A-Za-z0-9\s\-.]+$') THEN false WHEN regexp_matches(term, '^[0-9\s,\-–]+$') THEN false WHEN regexp_matches(term, '[0-9]') AND regexp_matches(term, '[A-Za-z]') THEN true WHEN regexp_matches(term, '(?:^|[^\p{L}\p{N}_])[IVX]+$') THEN true ELSE len(string_split(term, ' ')) = 1 AND length(term) <= 20 END")
per_term("prd18b_cyrillic_term", "cyrillic", V.cyrillic_term, "regexp_matches(term, '[А-ЯЁа-яё]{2,}')")
per_term("prd19a_looks_like_person", "person", V.looks_like_person, f"({NW} >= 2 OR regexp_matches(term, '[А-ЯЁ]\\.')) AND regexp_matches(term, '^[А-ЯЁ]') AND NOT regexp_matches(string_split(term, ' ')[1], '^[А-ЯЁ]{{5,}}$')")
per_term("prd19b_stopword_term", "stops", V.stopword_term, f"{NW} = 1 AND lower(term) IN ({', '.join(repr(w) for w in X.STOP)})")
GEN = f"CASE WHEN {NW} = 1 THEN false WHEN regexp_matches({LOWER1}, '({'|'.join(X.GENITIVE)})$') AND {LOWER1} NOT IN ({', '.join(repr(w) for w in X.COUNTRIES)}) THEN true WHEN {LOWER1} IN ({', '.join(repr(w) for w in X.COUNTRIES)}) AND lower(string_split(term, ' ')[2]) IN ({', '.join(repr(w) for w in X.VERB_MARKS)}) THEN true WHEN regexp_matches({LOWER1}, '^[0-9]+-го') THEN true ELSE len(list_filter(string_split(lower(term), ' '), lambda x: regexp_matches(x, '(ого|его)$'))) > 0 END"
per_term("prd20_genitive_fragment", "genitive", V.genitive_fragment, GEN)
STOPPED = ", ".join(repr(w) for w in [*X.STOP, *X.STOP_TEMPLATES])
DATES = " OR ".join(f"regexp_matches(term, '(?i){re2(p)}')" for p in X.ENGLISH_DATE)
VALID = f"length(term) BETWEEN 3 AND 100 AND NOT ({' OR '.join(f'''regexp_matches(term, '(?i){re2(p)}')''' if 'напомнил' in p else m(p) for p in X.REJECT)} OR {DATES}) AND lower(term) NOT IN ({STOPPED}) AND {LOWER1} NOT IN ({', '.join(repr(w) for w in X.STARTERS)}) AND NOT ({GEN}) AND {NW} <= 8 AND len(list_filter(string_split(lower(term), ' '), lambda x: x NOT IN ({STOPPED}))) > 0"
per_term("prd21_valid_term", "valid", V.valid_term, VALID)
per_term("prd22a_proper_noun", "proper", V.proper_noun, "regexp_matches(term, '^\\p{Lu}') OR regexp_matches(term, '^[0-9]\\S*\\s+\\p{Lu}')")
per_term("prd22b_military_rank", "ranked", V.military_rank, f"{LOWER1} IN ({', '.join(repr(w) for w in X.RANKS)}) AND coalesce(regexp_matches(string_split(term, ' ')[2], '^\\p{{Lu}}'), false)")
per_term("prd22c_military_unit", "unit", V.military_unit, f"regexp_matches(term, '(?i){X.UNIT}')")
per_term("prd22d_technical_term", "technical", V.technical, f"regexp_matches(term, '{X.TECHNICAL}')")
per_term("prd22e_abbreviation", "short", V.abbreviation, f"regexp_matches(term, '^\\p{{Lu}}{{1,4}}$') AND lower(term) NOT IN ({', '.join(repr(w) for w in X.WHITE_STOP)})")
per_term("prd22f_toponym", "toponym", V.toponym, f"regexp_matches(term, '^\\p{{Lu}}') AND regexp_matches(lower(term), '({'|'.join(X.TOPONYM)})$')")
VERB = "(" + " OR ".join(f"regexp_matches(term, '(?i){re2(p)}')" for p in X.VERBS_INSIDE) + ")"
per_term("prd22g_verb_inside", "verb", V.verb_inside, VERB)
per_term("prd22h_sentence_fragment", "fragment", V.sentence_fragment, f"{NW} > 5 OR {VERB}")
per_term("tx14_normalize_caps", "normal", V.normalize_caps, "array_to_string(list_transform(string_split(term, ' '), lambda x: CASE WHEN regexp_matches(x, '^\\p{Lu}{5,}$') THEN x[1] || lower(x[2:]) ELSE x END), ' ')")
per_term("tx13_clean_term", "cleaned", V.clean_term, r"trim(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(term, '&\w+;|&#\d+;', ' ', 'g'), '\[[^\]]*\]', '', 'g'), '\([^A-Za-z)][^)]*\)', '', 'g'), '\s[—–-]\s', ' ', 'g'), '[«»\x22]|\s+', ' ', 'g')), '.,;: ')")


def _case_sql() -> str:
    """The rules of TX15 for an engine without Unicode borders and looks behind; a border that two words share is given to the first, so such rules run twice."""
    sql, other = "term", r"[^\p{L}\p{N}_]"
    for p, to in X.CASE_ENDINGS:
        body = p.removesuffix(r"\b")
        if body.startswith("(?<="):
            find, put = rf"([\p{{L}}\p{{N}}_]){body.partition(')')[2]}($|{other})", rf"\1{to}\2"
        elif body.startswith(r"\b"):
            find, put = rf"(^|{other}){body[2:]}($|{other})", rf"\1{to}\2"
        else:
            find, put = rf"{body}($|{other})", r"\1\2"
        sql = f"regexp_replace({sql}, '(?i){find}', '{put}', 'g')"
        if body.startswith(r"\b"):
            sql = f"regexp_replace({sql}, '(?i){find}', '{put}', 'g')"
    return f"trim({sql})"


per_term("tx15_normalize_case", "normal", V.normalize_case, _case_sql())
per_term("tx16_normalize_term", "normal", V.normalize_term, r"trim(regexp_replace(term, '\s+', ' ', 'g'))")
REASON = f"CASE WHEN {DATES} THEN 'english date' WHEN {GEN} THEN 'genitive' WHEN NOT ({VALID}) THEN 'not valid' ELSE 'kept' END"
per_term("voc5_reject_reason", "reason", V.reject_reason, REASON)
WHITE = f"CASE WHEN lower(term) IN ({', '.join(repr(w) for w in X.WHITE_STOP)}) THEN 'stop' WHEN {NW} > 5 OR {VERB} THEN 'fragment' WHEN regexp_matches(term, '(?i){X.UNIT}') THEN 'unit' WHEN regexp_matches(term, '^\\p{{Lu}}') OR regexp_matches(term, '^[0-9]\\S*\\s+\\p{{Lu}}') THEN 'proper' WHEN {LOWER1} IN ({', '.join(repr(w) for w in X.RANKS)}) AND coalesce(regexp_matches(string_split(term, ' ')[2], '^\\p{{Lu}}'), false) THEN 'rank' ELSE 'other' END"
per_term("voc6_white_list", "kind", V.white_list, WHITE)


@query("ag8_filter_stats", f"SELECT {REASON} AS reason, count(*) AS n FROM dt GROUP BY 1", VT)
def ag8(spark: SparkSession, d: str) -> DataFrame:
    return distinct_terms(spark, d).groupBy(V.reject_reason(F.col("term")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


RANKED = "CASE WHEN regexp_matches(term, '^\\p{Lu}') THEN 0 ELSE 1 END"


@query("ag7_frequency_best_variant", f"SELECT lower(term) AS low, arg_min(term, ({RANKED}, category, source, doc_id, pos)) AS best, count(*) AS freq FROM terms GROUP BY 1", TERMS)
def ag7(spark: SparkSession, d: str) -> DataFrame:
    """Terms without regard to case: how often, and the first capitalised writing."""
    cls = F.when(F.col("term").rlike(r"^\p{Lu}"), 0).otherwise(1)
    return terms(spark, d).groupBy(F.lower("term").alias("low")).agg(F.min_by("term", F.struct(cls.alias("a"), "category", "source", "doc_id", "pos")).alias("best"), F.count(F.lit(1)).alias("freq"))


@query("ag15_distinct_first_wins", "SELECT category, lower(term) AS low, arg_min(term, (source, doc_id, pos)) AS term FROM terms GROUP BY 1, 2", TERMS)
def ag15(spark: SparkSession, d: str) -> DataFrame:
    return terms(spark, d).groupBy("category", F.lower("term").alias("low")).agg(F.min_by("term", F.struct("source", "doc_id", "pos")).alias("term"))


FREQ = "fr AS (SELECT lower(term) AS low, count(*) AS f FROM terms GROUP BY 1)"


@query("ag9_weight_bands", "SELECT low, CAST(CASE WHEN f >= 0.5 * m THEN 5 WHEN f >= 0.2 * m THEN 4 WHEN f >= 0.05 * m THEN 3 WHEN f >= 0.01 * m THEN 2 ELSE 1 END AS INTEGER) AS weight FROM fr, (SELECT max(f) AS m FROM fr)", f"{TERMS}, {FREQ}")
def ag9(spark: SparkSession, d: str) -> DataFrame:
    f = terms(spark, d).groupBy(F.lower("term").alias("low")).agg(F.count(F.lit(1)).alias("f"))
    return weighted(cut(f, "frequencies")).select("low", "weight")


def weighted(f: DataFrame) -> DataFrame:
    """AG9: f (low, f) with the weight of each term by its share of the greatest frequency."""
    bands, most = F, F.col("most")
    for share, weight in X.WEIGHT_BANDS:
        bands = bands.when(F.col("f") >= share * most, weight)
    return f.join(F.broadcast(f.agg(F.max("f").alias("most")))).withColumn("weight", bands.otherwise(1).cast("int")).drop("most")  # one row


@query("ag11_raw_dict_stats", "SELECT category, source, count(*) AS n, count(DISTINCT lower(term)) AS n_distinct FROM terms GROUP BY 1, 2", TERMS)
def ag11(spark: SparkSession, d: str) -> DataFrame:
    return terms(spark, d).groupBy("category", "source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.lower("term")).alias("n_distinct"))


@query("snk5_raw_dict_union", "SELECT category, source, doc_id, pos, term FROM terms", TERMS)
def snk5(spark: SparkSession, d: str) -> DataFrame:
    return terms(spark, d)


@query("snk7_hot_words", "SELECT DISTINCT term || ':' || weight AS line FROM vocab WHERE term IS NOT NULL AND weight IS NOT NULL")
def snk7(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "vocab").filter("term is not null and weight is not null").select(F.concat_ws(":", "term", F.col("weight").cast("string")).alias("line")).distinct()


CORPUS = "lv AS (SELECT DISTINCT lower(term) AS low FROM vocab WHERE term IS NOT NULL AND trim(term) <> ''), ct AS (SELECT low, CAST(sum((length(t) - length(replace(t, low, ''))) // length(low)) AS BIGINT) AS n FROM lv, (SELECT lower(text) AS t FROM documents WHERE text IS NOT NULL) WHERE contains(t, low) GROUP BY low)"


@query("jn14_frequency_in_corpus", "SELECT low, n FROM ct", CORPUS)
def jn14(spark: SparkSession, d: str) -> DataFrame:
    """How often each term of the dictionary stands in all texts, as a substring without regard to case."""
    return term_counts(read(spark, d, "documents"), "text", read(spark, d, "vocab"))


@query("voc7_frequency_weights", "SELECT term, f AS n, CAST(CASE WHEN f >= 0.5 * m THEN 5 WHEN f >= 0.2 * m THEN 4 WHEN f >= 0.05 * m THEN 3 WHEN f >= 0.01 * m THEN 2 ELSE 1 END AS INTEGER) AS weight FROM (SELECT v.term, coalesce(n, 1) AS f FROM (SELECT DISTINCT term FROM vocab WHERE term IS NOT NULL) v LEFT JOIN ct ON ct.low = lower(v.term)), (SELECT coalesce(max(n), 1) AS m FROM ct)", CORPUS)
def voc7(spark: SparkSession, d: str) -> DataFrame:
    """The weight of each term by its occurrences in the corpus; one that does not occur counts as if it did once."""
    n = cut(jn14(spark, d), "counts")
    v = read(spark, d, "vocab").filter("term is not null").select("term").distinct()
    f = v.join(n, F.lower("term") == n.low, "left").select("term", F.coalesce("n", F.lit(1)).alias("f"))
    bands, most = F, F.col("most")
    for share, weight in X.WEIGHT_BANDS:
        bands = bands.when(F.col("f") >= share * most, weight)
    f = f.join(F.broadcast(n.agg(F.coalesce(F.max("n"), F.lit(1)).alias("most"))))  # one row
    return f.select("term", F.col("f").alias("n"), bands.otherwise(1).cast("int").alias("weight"))


# correctors -------------------------------------------------------------------------------------------------------

TOK = r"tk AS (SELECT DISTINCT lower(x) AS w FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) AS x FROM documents WHERE text IS NOT NULL)), vw AS (SELECT DISTINCT lower(x) AS v FROM (SELECT unnest(regexp_extract_all(surname, '[A-Za-z]{4,}')) AS x FROM audio_files WHERE surname IS NOT NULL))"


def latin_words(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    w = read(spark, d, "documents").filter("text is not null").select(F.explode(F.expr("regexp_extract_all(text, '[A-Za-z]{4,}', 0)")).alias("w")).select(F.lower("w").alias("w")).distinct()
    v = read(spark, d, "audio_files").filter("surname is not null").select(F.explode(F.expr("regexp_extract_all(surname, '[A-Za-z]{4,}', 0)")).alias("v")).select(F.lower("v").alias("v")).distinct()
    return w, v


@query("voc10_exact_corrector", "SELECT w, v FROM tk JOIN vw ON w = v", TOK)
def voc10(spark: SparkSession, d: str) -> DataFrame:
    w, v = latin_words(spark, d)
    return w.join(v, w.w == v.v)


@query("voc11_fuzzy_corrector", "SELECT w, v, CAST(levenshtein(w, v) AS INTEGER) AS dist FROM tk JOIN vw ON abs(length(w) - length(v)) <= 2 AND levenshtein(w, v) <= 2", TOK)
def voc11(spark: SparkSession, d: str) -> DataFrame:
    """Pairs within two edits; words that share no deletion neighbourhood never meet."""
    return V.fuzzy_pairs(*latin_words(spark, d))


PHON = "translate(regexp_replace(w[1] || regexp_replace(w[2:], '[aeiouy]', '', 'g'), '(.)', '\\1', 'g'), 'bdgvz', 'ptkfs')"


@query("voc12_phonetic_corrector", f"SELECT w, v FROM (SELECT w, {PHON} AS k FROM tk) JOIN (SELECT v, {PHON.replace('w[', 'v[')} AS k FROM vw) USING (k) WHERE w <> v", TOK)
def voc12(spark: SparkSession, d: str) -> DataFrame:
    w, v = latin_words(spark, d)
    key = lambda c: F.translate(F.concat(F.substring(c, 1, 1), F.regexp_replace(F.expr(f"substr({c}, 2)"), "[aeiouy]", "")), "bdgvz", "ptkfs")
    return w.withColumn("k", key("w")).join(v.withColumn("k", key("v")), "k").filter("w <> v").select("w", "v")


# the same four layers over all words of all texts and the whole dictionary

WORD = r"[\p{L}]+"
LAYERS = rf"""dw AS (SELECT lower(v) AS k, max(v) AS v, max(weight) AS weight, bool_or(who) AS who FROM (SELECT unnest(regexp_extract_all(term, '{WORD}')) AS v, weight, category = 'person' AS who FROM vocab WHERE term IS NOT NULL UNION ALL SELECT unnest(regexp_extract_all(surname, '{WORD}')), 5, true FROM audio_files WHERE surname IS NOT NULL) WHERE length(v) >= 4 AND regexp_matches(v, '^\p{{Lu}}') GROUP BY 1),
 tw AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS w FROM documents WHERE text IS NOT NULL) WHERE length(w) >= 4 GROUP BY 1),
 uw AS (SELECT lower(w) AS w, CAST(sum(n) AS BIGINT) AS n FROM tw WHERE lower(w) NOT IN (SELECT k FROM dw) GROUP BY 1)"""
_DIST = f"CAST(levenshtein(translate(w, '{V.LETTERS[0]}äöüß', '{V.LETTERS[1]}aous'), translate(k, '{V.LETTERS[0]}äöüß', '{V.LETTERS[1]}aous')) AS INTEGER)"


def dictionary_words(spark: SparkSession, d: str) -> DataFrame:
    """(k, v, weight, who): the capitalised words of the dictionary and the surnames, in lower case and as they are written; who: words of persons."""
    word = lambda c: F.explode(F.expr(rf"regexp_extract_all({c}, '[\\p{{L}}]+', 0)"))
    v = read(spark, d, "vocab").filter("term is not null").select(word("term").alias("v"), "weight", (F.col("category") == "person").alias("who"))
    v = v.unionByName(read(spark, d, "audio_files").filter("surname is not null").select(word("surname").alias("v"), F.lit(5).alias("weight"), F.lit(True).alias("who")))
    v = v.filter((F.length("v") >= 4) & F.col("v").rlike(r"^\p{Lu}"))
    return v.groupBy(F.lower("v").alias("k")).agg(F.max("v").alias("v"), F.max("weight").alias("weight"), F.bool_or("who").alias("who"))


def text_words(spark: SparkSession, d: str) -> DataFrame:
    """(w, n): the words of four letters or more of all texts, as they are written."""
    w = read(spark, d, "documents").filter("text is not null").select(F.explode(F.expr(r"regexp_extract_all(text, '[\\p{L}]+', 0)")).alias("w"))
    return w.filter(F.length("w") >= 4).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


def unknown_words(spark: SparkSession, d: str, known: DataFrame) -> DataFrame:
    low = text_words(spark, d).groupBy(F.lower("w").alias("w")).agg(F.sum("n").alias("n"))
    return low.join(known.select(F.col("k").alias("w")), "w", "left_anti")


@query("voc10_case_corrector", "SELECT w, v, n FROM tw JOIN dw ON lower(w) = k AND w <> v", LAYERS)
def voc10_case(spark: SparkSession, d: str) -> DataFrame:
    """Words of the texts that the dictionary writes with other letter case."""
    t, v = text_words(spark, d), dictionary_words(spark, d)
    return t.join(v, (F.lower(t.w) == v.k) & (t.w != v.v)).select("w", "v", "n")


def folded(c: str) -> Column:
    """A word in single signs of ASCII, so that all engines count the same distance."""
    return F.translate(F.col(c), V.LETTERS[0] + "äöüß", V.LETTERS[1] + "aous")


def fuzzy(words: DataFrame, known: DataFrame) -> DataFrame:
    """(w, k, v, weight, who, dist): dictionary words within two edits of a word."""
    near = V.fuzzy_pairs(words.select(folded("w").alias("w")).distinct(), known.select(folded("k").alias("v")).distinct())
    near = near.withColumnsRenamed({"w": "fw", "v": "fk"})
    return words.withColumn("fw", folded("w")).join(near, "fw").join(known.withColumn("fk", folded("k")), "fk").drop("fw", "fk")


_BEST = "arg_min(v, (-weight, dist, -length(v), v)) AS v, arg_min(dist, (-weight, dist, -length(v), v)) AS dist"


@query("voc11_dictionary_corrector", f"SELECT w, n, {_BEST} FROM (SELECT w, n, v, weight, {_DIST} AS dist FROM uw JOIN dw ON abs(length(w) - length(k)) <= 2) WHERE dist <= 2 GROUP BY w, n", LAYERS)
def voc11_all(spark: SparkSession, d: str) -> DataFrame:
    """Unknown words of the texts and the dictionary word within two edits that corrects each."""
    known = cut(dictionary_words(spark, d), "dictionary")
    return V.best_of(fuzzy(unknown_words(spark, d, known), known), ["w", "n"]).select("w", "n", "v", "dist")


def _key_sql(c: str) -> str:
    low = f"translate({c}, 'ьъ', '')"
    return f"translate({low}[1] || regexp_replace({low}[2:], '[{V.VOWELS}]', '', 'g'), '{V.VOICED}', '{V.VOICELESS}')"


@query("voc12_surname_corrector", f"SELECT w, n, {_BEST} FROM (SELECT w, n, v, weight, {_DIST} AS dist FROM (SELECT *, {_key_sql('w')} AS key FROM uw) JOIN (SELECT *, {_key_sql('k')} AS key FROM dw WHERE who) USING (key)) GROUP BY w, n", LAYERS)
def voc12_all(spark: SparkSession, d: str) -> DataFrame:
    """Unknown words that sound like the word of a person, and that word."""
    known = cut(dictionary_words(spark, d), "dictionary")
    pairs = unknown_words(spark, d, known).withColumn("key", V.phonetic_key(F.col("w"))).join(known.filter("who").withColumn("key", V.phonetic_key(F.col("k"))), "key")
    return V.best_of(pairs.withColumn("dist", F.levenshtein(folded("w"), folded("k"))), ["w", "n"]).select("w", "n", "v", "dist")


TITLES = rf"""ti AS (SELECT DISTINCT lower(p[1]) AS title, p[2] AS v, lower(p[2]) AS k, weight FROM (SELECT regexp_extract_all(term, '{WORD}(?:-{WORD})*') AS p, weight FROM vocab WHERE category = 'person') WHERE len(p) = 2),
 bg AS (SELECT title, w, count(*) AS n FROM (SELECT lower(p[i]) AS title, lower(unnest(p[i + 1:i + 2])) AS w FROM (SELECT regexp_extract_all(text, '{WORD}(?:-{WORD})*') AS p FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(p))) AS i) WHERE lower(p[i]) IN (SELECT title FROM ti)) WHERE length(w) >= 4 GROUP BY 1, 2)"""


@query("voc13_title_corrector", f"SELECT title, w, n, {_BEST} FROM (SELECT bg.title, w, n, v, weight, {_DIST} AS dist, {_key_sql('w')} = {_key_sql('k')} AS alike FROM bg JOIN ti ON ti.title = bg.title WHERE w <> k AND NOT EXISTS (SELECT 1 FROM ti t2 WHERE t2.k = bg.w)) WHERE dist <= 2 OR alike GROUP BY title, w, n", f"{LAYERS}, {TITLES}")
def voc13_all(spark: SparkSession, d: str) -> DataFrame:
    """Words one or two places after a title that are near, in letters or sound, to a person whom the dictionary names with that title; such a pair goes before a single word."""
    word = r"[\\p{L}]+(?:-[\\p{L}]+)*"
    t = read(spark, d, "vocab").filter("category = 'person'").select(F.expr(f"regexp_extract_all(term, '{word}', 0)").alias("p"), "weight").filter("size(p) = 2")
    t = cut(t.select(F.lower(F.col("p")[0]).alias("title"), F.col("p")[1].alias("v"), F.lower(F.col("p")[1]).alias("k"), "weight").distinct(), "titles")
    p = read(spark, d, "documents").filter("text is not null").select(F.expr(f"transform(regexp_extract_all(text, '{word}', 0), x -> lower(x))").alias("p"))
    pairs = p.select(F.explode(F.expr("flatten(transform(p, (x, i) -> transform(slice(p, i + 2, 2), w -> struct(x as title, w as w))))")).alias("x")).select("x.title", "x.w").filter("length(w) >= 4")
    pairs = pairs.join(t.select("title").distinct(), "title", "left_semi").groupBy("title", "w").agg(F.count(F.lit(1)).alias("n")).join(t.select(F.col("k").alias("w")), "w", "left_anti")
    pairs = cut(pairs, "pairs")
    near = fuzzy(pairs.select("w").distinct(), t.select("k").distinct()).select("w", "k")
    alike = pairs.select("w").distinct().withColumn("key", V.phonetic_key(F.col("w"))).join(t.select("k").distinct().withColumn("key", V.phonetic_key(F.col("k"))), "key").select("w", "k")
    found = pairs.join(near.unionByName(alike).distinct(), "w").join(t, ["title", "k"])
    return V.best_of(found.withColumn("dist", F.levenshtein(folded("w"), folded("k"))), ["title", "w", "n"]).select("title", "w", "n", "v", "dist")


@query("voc13_context_bigrams", r"SELECT rank, name, count(*) AS n FROM (SELECT lower(p[i]) AS rank, p[i + 1] AS name FROM (SELECT regexp_split_to_array(text, '[^\p{L}\p{N}]+') AS p FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(p))) AS i)) WHERE rank IN ('майор', 'капитан', 'полковник', 'старшина', 'лейтенант') AND regexp_matches(name, '^[А-ЯЁ]') GROUP BY 1, 2")
def voc13(spark: SparkSession, d: str) -> DataFrame:
    """Rank and surname as neighbours: the bigrams that a corrector prefers."""
    r = read(spark, d, "documents").filter("text is not null").select(F.split("text", r"[^\p{L}\p{N}]+").alias("p")).filter(F.size("p") > 1)
    z = F.explode(F.arrays_zip(F.expr("slice(p, 1, size(p) - 1)").alias("a"), F.expr("slice(p, 2, size(p) - 1)").alias("b")))
    r = r.select(z.alias("z")).select(F.lower("z.a").alias("rank"), F.col("z.b").alias("name"))
    return r.filter(F.col("rank").isin("майор", "капитан", "полковник", "старшина", "лейтенант") & F.col("name").rlike("^[А-ЯЁ]")).groupBy("rank", "name").agg(F.count(F.lit(1)).alias("n"))


@query("voc14_alias_table", "SELECT s.seg_id, a.role_name FROM seg s JOIN (SELECT lower(trim(alias)) AS k, max(role_name) AS role_name FROM role_aliases GROUP BY 1) a ON a.k = lower(trim(s.speaker))", SEG)
def voc14(spark: SparkSession, d: str) -> DataFrame:
    """The role that the label of the valid delivery is another word for."""
    a = read(spark, d, "role_aliases").groupBy(F.lower(F.trim("alias")).alias("k")).agg(F.max("role_name").alias("role_name"))
    return segments(spark, d, "speaker").join(a, F.lower(F.trim("speaker")) == F.col("k")).select("seg_id", "role_name")


# addresses and pages ----------------------------------------------------------------------------------------------

HOST = "regexp_extract(lower(url), '^https?://([^/?#]*)', 1)"
DOMAIN = f"regexp_replace({HOST}, '^[w.]+', '')"


def domain(url: Column) -> Column:
    """Characters w and . are stripped from the left, as a set."""
    return F.regexp_replace(F.regexp_extract(F.lower(url), r"^https?://([^/?#]*)", 1), "^[w.]+", "")


@query("tx17_url_parts", f"SELECT page_id, {DOMAIN} AS domain, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '[?]([^#]*)', 1) AS query, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS base FROM rkka WHERE url IS NOT NULL")
def tx17(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    return read(spark, d, "rkka").filter("url is not null").select("page_id", domain(u).alias("domain"), F.regexp_extract(u, r"^https?://[^/?#]*([^?#]*)", 1).alias("path"), F.regexp_extract(u, r"[?]([^#]*)", 1).alias("query"), F.regexp_extract(u, r"^(https?://[^/?#]*)", 1).alias("base"))


LINKS = r"li AS (SELECT page_id, host, url, CAST(i - 1 AS INTEGER) AS pos, h[i] AS href FROM (SELECT page_id, host, url, regexp_extract_all(html, 'href=" + '"' + r"([^" + '"' + r"]*)" + '"' + r"', 1) AS h FROM rkka WHERE html IS NOT NULL), LATERAL (SELECT unnest(range(1, len(h) + 1)) AS i))"


def links(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter("html is not null").select("page_id", "host", "url", F.posexplode(F.expr("regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)")).alias("pos", "href"))


@query("prd17_chapter_links", f"SELECT page_id, pos, href FROM li WHERE NOT regexp_matches(href, '^(#|mailto:|javascript:|https?:)') AND regexp_matches(regexp_extract(href, '([^/]*)$', 1), '{X.CHAPTER_LINK}')", LINKS)
def prd17(spark: SparkSession, d: str) -> DataFrame:
    return links(spark, d).filter(~F.col("href").rlike("^(#|mailto:|javascript:|https?:)") & F.regexp_extract("href", "([^/]*)$", 1).rlike(X.CHAPTER_LINK)).select("page_id", "pos", "href")


@query("dd6_url_dedupe_in_category", "SELECT host, href, min(page_id) AS first_page FROM li GROUP BY 1, 2", LINKS)
def dd6(spark: SparkSession, d: str) -> DataFrame:
    return links(spark, d).groupBy("host", "href").agg(F.min("page_id").alias("first_page"))


@query("dd7_first_fifteen_links", "SELECT page_id, href, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM (SELECT page_id, href, min(pos) AS pos FROM li GROUP BY 1, 2)) WHERE rn <= 15", LINKS)
def dd7(spark: SparkSession, d: str) -> DataFrame:
    r = links(spark, d).groupBy("page_id", "href").agg(F.min("pos").alias("pos"))
    return r.withColumn("rn", F.row_number().over(W.partitionBy("page_id").orderBy("pos"))).filter("rn <= 15").select("page_id", "href", "rn")


PARSE = f"CASE WHEN regexp_matches(url, '[$][{{]') THEN 'manual' WHEN {DOMAIN} IN ('t.me', 'telegram.me') THEN 'manual' WHEN {DOMAIN} IN ('pamyat-naroda.ru', 'podvignaroda.ru') THEN 'api' WHEN status_code IS NULL THEN 'dead' WHEN status_code IN (404, 410) THEN 'dead' WHEN status_code IN (401, 403) THEN 'manual' WHEN status_code >= 500 THEN 'dead' WHEN {DOMAIN} IN ('warspot.ru', 'waralbum.ru', 'allaces.ru') THEN 'selenium' WHEN status_code = 200 THEN 'requests+bs4' ELSE 'manual' END"


@query("prd23_parse_method", f"SELECT page_id, {PARSE} AS method FROM rkka WHERE url IS NOT NULL")
def prd23(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter("url is not null").select("page_id", V.parse_method(F.col("url"), domain(F.col("url")), F.col("status_code")).alias("method"))


PRIO = f"CASE WHEN {DOMAIN} IN ({', '.join(repr(x) for x in X.PRIORITY_HIGH)}) THEN 'HIGH' WHEN {DOMAIN} IN ({', '.join(repr(x) for x in X.PRIORITY_MED)}) THEN 'MED' ELSE 'LOW' END"


@query("prd24_priority", f"SELECT page_id, {PRIO} AS priority FROM rkka WHERE url IS NOT NULL")
def prd24(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter("url is not null").select("page_id", V.priority(domain(F.col("url"))).alias("priority"))


@query("ag10_audit_summary", f"SELECT {DOMAIN} AS domain, count(*) FILTER (WHERE method = 'requests+bs4') AS n_parse, count(*) FILTER (WHERE method = 'dead') AS n_dead, count(*) FILTER (WHERE method = 'manual') AS n_manual FROM (SELECT url, {PARSE} AS method FROM rkka WHERE url IS NOT NULL) GROUP BY 1")
def ag10(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("url")
    r = read(spark, d, "rkka").filter("url is not null").select(domain(u).alias("domain"), V.parse_method(u, domain(u), F.col("status_code")).alias("method"))
    c = lambda x: F.count_if(F.col("method") == x)
    return r.groupBy("domain").agg(c("requests+bs4").alias("n_parse"), c("dead").alias("n_dead"), c("manual").alias("n_manual"))


@query("voc4_parser_dispatch", f"SELECT page_id, CASE WHEN contains({DOMAIN}, 'wiki') THEN 'wiki' WHEN contains({DOMAIN}, 'militera') THEN 'militera' WHEN contains({DOMAIN}, 'rkka') THEN 'rkka' ELSE 'none' END AS parser FROM rkka WHERE url IS NOT NULL")
def voc4(spark: SparkSession, d: str) -> DataFrame:
    x = domain(F.col("url"))
    e = F.when(F.contains(x, F.lit("wiki")), "wiki").when(F.contains(x, F.lit("militera")), "militera").when(F.contains(x, F.lit("rkka")), "rkka").otherwise("none")
    return read(spark, d, "rkka").filter("url is not null").select("page_id", e.alias("parser"))


@query("prd16_url_filter", f"SELECT page_id, url FROM rkka WHERE url IS NOT NULL AND url <> '' AND contains({DOMAIN}, 'rkka') AND status_code = 200")
def prd16(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter((F.col("url") != "") & F.contains(domain(F.col("url")), F.lit("rkka")) & (F.col("status_code") == 200)).select("page_id", "url")


@query("src9_url_csv", "SELECT page_id, trim(url) AS url, lower(coalesce(charset, '')) AS parseable, upper(coalesce(host, '')) AS priority FROM rkka WHERE url IS NOT NULL")
def src9(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter("url is not null").select("page_id", F.trim("url").alias("url"), F.lower(F.coalesce("charset", F.lit(""))).alias("parseable"), F.upper(F.coalesce("host", F.lit(""))).alias("priority"))


@query("src12_cache_keys", f"SELECT page_id, {DOMAIN} || '/' || md5(url) || '.html' AS path FROM rkka WHERE url IS NOT NULL")
def src12(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "rkka").filter("url is not null").select("page_id", F.concat(domain(F.col("url")), F.lit("/"), F.md5("url"), F.lit(".html")).alias("path"))


@query("tx18_urls_in_text", r"SELECT page_id, rtrim(u, '.,;:') AS found FROM (SELECT page_id, unnest(regexp_extract_all('См. ' || url || '.', 'https?://[^\s\]>\x22''<\)]+')) AS u FROM rkka WHERE url IS NOT NULL)")
def tx18(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "rkka").filter("url is not null").select("page_id", F.concat(F.lit("См. "), "url", F.lit(".")).alias("t"))
    return r.select("page_id", F.explode(F.regexp_extract_all("t", F.lit("(" + X.URL_PATTERN + ")"), F.lit(1))).alias("u")).select("page_id", F.regexp_replace("u", "[.,;:]+$", "").alias("found"))


@query("src10_sticky_categories", "SELECT page_id, last_value(cat IGNORE NULLS) OVER (PARTITION BY host ORDER BY page_id) AS category FROM (SELECT page_id, host, CASE WHEN page_id % 7 = 0 THEN 'КАТЕГОРИЯ ' || page_id % 13 END AS cat FROM rkka WHERE host IS NOT NULL)")
def src10(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh page stands for a category header; the pages after it inherit the category."""
    from tapeloom.operators.ordered import with_last

    cat = F.when(F.pmod("page_id", F.lit(7)) == 0, F.concat(F.lit("КАТЕГОРИЯ "), F.pmod("page_id", F.lit(13)).cast("string")))
    r = read(spark, d, "rkka").filter("host is not null").select("page_id", "host", cat.alias("cat"))
    return with_last(r, "host", ["page_id"], F.col("cat"), "before", chunk=1000).select("page_id", F.coalesce("cat", "before").alias("category"))


ANCHOR = r"an AS (SELECT page_id, trim(regexp_replace(a[i], '<[^>]*>', '', 'g')) AS t FROM (SELECT page_id, regexp_extract_all(html, '<a href=" + '"[^"]*"' + r">([^<]*)</a>', 1) AS a FROM rkka WHERE html IS NOT NULL), LATERAL (SELECT unnest(range(1, len(a) + 1)) AS i))"


@query("voc1a_link_terms", "SELECT DISTINCT page_id, t AS term FROM an WHERE length(t) BETWEEN 3 AND 80 AND regexp_matches(t, '[А-ЯЁа-яё]{2,}')", ANCHOR)
def voc1a(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "rkka").filter("html is not null").select("page_id", F.explode(F.expr("regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1)")).alias("t")).withColumn("t", F.trim("t"))
    return r.filter(F.length("t").between(3, 80) & F.col("t").rlike("[А-ЯЁа-яё]{2,}")).select("page_id", F.col("t").alias("term")).distinct()


CELLS = r"ce AS (SELECT page_id, trim(c[i], ' ') AS t FROM (SELECT page_id, regexp_extract_all(html, '<td>([^<]*)</td>', 1) AS c FROM rkka WHERE html IS NOT NULL), LATERAL (SELECT unnest(range(1, len(c) + 1)) AS i))"


@query("voc3a_table_cells", "SELECT DISTINCT page_id, t AS term FROM ce WHERE length(t) BETWEEN 3 AND 80 AND regexp_matches(t, '[А-ЯЁа-яё]')", CELLS)
def voc3a(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "rkka").filter("html is not null").select("page_id", F.explode(F.expr("regexp_extract_all(html, '<td>([^<]*)</td>', 1)")).alias("t")).withColumn("t", F.trim("t"))
    return r.filter(F.length("t").between(3, 80) & F.col("t").rlike("[А-ЯЁа-яё]")).select("page_id", F.col("t").alias("term")).distinct()


def from_text(name: str, pattern: str, group: int = 0) -> None:
    """Terms that a pattern finds in documents, with how often."""

    @query(name, f"SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{pattern}', {group})) AS term FROM documents WHERE text IS NOT NULL) GROUP BY 1")
    def run(spark: SparkSession, d: str) -> DataFrame:
        r = read(spark, d, "documents").filter("text is not null").select(F.explode(F.regexp_extract_all("text", F.lit(pattern if group else f"({pattern})"), F.lit(1))).alias("term"))
        return r.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


from_text("voc2c_rank_names", "(?:Майор|Капитан|Полковник|Подполковник|Старшина|Лейтенант|майор|капитан|полковник|подполковник|старшина|лейтенант) [А-ЯЁ][а-яё]+")
from_text("voc2d_quoted_terms", "«([^»]{3,60})»", 1)
from_text("voc2e_unit_names", "[0-9]+-я (?:стрелковая|танковая|кавалерийская|артиллерийская|лыжная|сапёрная|ударная) (?:дивизия|бригада|рота|армия)")
from_text("voc2f_capital_sequences", "[А-ЯЁ][а-яё]+(?: [А-ЯЁ][а-яё]+)+")


# snapshots and sinks ----------------------------------------------------------------------------------------------

SNAP = SEG + ", old AS (SELECT file_id, start_us, speaker, max(text) AS text FROM seg WHERE seg_id % 10 <> 3 GROUP BY 1, 2, 3), new AS (SELECT file_id, start_us, speaker, max(CASE WHEN seg_id % 17 = 0 THEN upper(text) ELSE text END) AS text FROM seg WHERE seg_id % 10 <> 5 GROUP BY 1, 2, 3)"


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of the same transcripts: some rows lost, some gained, some changed."""
    s = segments(spark, d, "speaker", "text")
    keys = ["file_id", "start_us", "speaker"]
    old = s.filter(F.pmod("seg_id", F.lit(10)) != 3).groupBy(*keys).agg(F.max("text").alias("old_text"))
    new = s.filter(F.pmod("seg_id", F.lit(10)) != 5).groupBy(*keys).agg(F.max(F.when(F.pmod("seg_id", F.lit(17)) == 0, F.upper("text")).otherwise(F.col("text"))).alias("new_text"))
    return old.withColumn("o", F.lit(1)), new.withColumn("n", F.lit(1))


@query("jn11_snapshot_diff", "SELECT coalesce(o.file_id, n.file_id) AS file_id, CASE WHEN n.file_id IS NULL THEN 'lost' WHEN o.file_id IS NULL THEN 'gained' WHEN o.text IS DISTINCT FROM n.text THEN 'changed' ELSE 'same' END AS state, count(*) AS n FROM old o FULL JOIN new n ON o.file_id = n.file_id AND o.start_us = n.start_us AND o.speaker = n.speaker GROUP BY 1, 2", SNAP)
def jn11(spark: SparkSession, d: str) -> DataFrame:
    old, new = snapshots(spark, d)
    j = old.join(new, ["file_id", "start_us", "speaker"], "full_outer")
    state = F.when(F.col("n").isNull(), "lost").when(F.col("o").isNull(), "gained").when(~F.col("old_text").eqNullSafe(F.col("new_text")), "changed").otherwise("same")
    return j.groupBy("file_id", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("jn12_line_set_diff", "SELECT text FROM old WHERE text IS NOT NULL EXCEPT SELECT text FROM new WHERE text IS NOT NULL", SNAP)
def jn12(spark: SparkSession, d: str) -> DataFrame:
    old, new = snapshots(spark, d)
    return old.filter("old_text is not null").select(F.col("old_text").alias("text")).subtract(new.filter("new_text is not null").select("new_text"))


@query("jn13_line_bag_diff", "SELECT (SELECT count(*) FROM (SELECT text FROM old EXCEPT ALL SELECT text FROM new)) AS minus, (SELECT count(*) FROM (SELECT text FROM new EXCEPT ALL SELECT text FROM old)) AS plus", SNAP)
def jn13(spark: SparkSession, d: str) -> DataFrame:
    old, new = snapshots(spark, d)
    a, b = old.select(F.col("old_text").alias("t")), new.select(F.col("new_text").alias("t"))
    both = a.exceptAll(b).select(F.lit(1).alias("m")).unionByName(b.exceptAll(a).select(F.lit(0).alias("m")))
    return both.agg(F.count_if(F.col("m") == 1).alias("minus"), F.count_if(F.col("m") == 0).alias("plus"))


@query("set_intersect_keys", "SELECT file_id, start_us, speaker FROM old INTERSECT SELECT file_id, start_us, speaker FROM new", SNAP)
def keys(spark: SparkSession, d: str) -> DataFrame:
    old, new = snapshots(spark, d)
    k = ["file_id", "start_us", "speaker"]
    return old.select(*k).intersect(new.select(*k))


LINE = "format('{:02d}:{:02d}:{:02d}', CAST(floor(start_us / 1e6) AS BIGINT) // 3600, (CAST(floor(start_us / 1e6) AS BIGINT) % 3600) // 60, CAST(floor(start_us / 1e6) AS BIGINT) % 60)"


@query("snk3_txt_lines", f"SELECT file_id, seg_id, {LINE} || ' ' || speaker || ': ' || text AS line FROM seg WHERE text IS NOT NULL", SEG)
def snk3(spark: SparkSession, d: str) -> DataFrame:
    return segments(spark, d, "speaker", "text").filter("text is not null").select("file_id", "seg_id", F.concat(hms(F.col("start_us")), F.lit(" "), "speaker", F.lit(": "), "text").alias("line"))


def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """SNK1: one nested document for each tape of a recording, its segments in order; a tape bounds a document, however long the recording is."""
    r = segments(spark, d, "tape_no", "speaker", "text")
    return r.groupBy("file_id", "tape_no").agg(F.count(F.lit(1)).alias("n_segments"), F.sort_array(F.collect_list(F.struct("start_us", "seg_id", "end_us", "speaker", "text"))).alias("segments"))


@query("snk1_src5_json_round_trip", "SELECT file_id, count(*) AS n_segments, min(start_us) AS first_us, arg_min(speaker, (start_us, seg_id)) AS first_speaker FROM seg GROUP BY 1", SEG)
def snk1(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts of tapes written as JSON documents, read again with a fixed schema, and summed for each recording."""
    from tapeloom.sources.transcripts import read_transcripts, write_transcripts

    r = read_transcripts(spark, write_transcripts(transcripts(spark, d))).withColumn("first", F.col("segments")[0])
    at = F.struct("first.start_us", "first.seg_id")
    return r.groupBy("file_id").agg(F.sum("n_segments").alias("n_segments"), F.min("first.start_us").alias("first_us"), F.min_by("first.speaker", at).alias("first_speaker"))


@query("src7_term_files", "SELECT term, count(*) AS n FROM terms GROUP BY 1", TERMS)
def src7(spark: SparkSession, d: str) -> DataFrame:
    """Term lists written as text files by category, scanned again: blank lines left out, ends stripped."""
    from tapeloom.sources.term_files import read_terms, write_terms

    return read_terms(spark, write_terms(terms(spark, d))).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("ag14_parser_run", "SELECT host, count(*) AS total, count(*) FILTER (WHERE NOT skipped AND n > 0) AS success, count(*) FILTER (WHERE NOT skipped AND n = 0) AS failed, count(*) FILTER (WHERE skipped) AS skipped, CAST(coalesce(sum(n) FILTER (WHERE NOT skipped), 0) AS BIGINT) AS terms FROM (SELECT p.host, p.method <> 'requests+bs4' AS skipped, coalesce(t.n, 0) AS n FROM (SELECT page_id, host, " + PARSE + " AS method FROM rkka WHERE url IS NOT NULL AND host IS NOT NULL) p LEFT JOIN (SELECT page_id, count(DISTINCT t) AS n FROM an WHERE length(t) BETWEEN 3 AND 80 AND regexp_matches(t, '[А-ЯЁа-яё]{2,}') GROUP BY 1) t ON t.page_id = p.page_id) GROUP BY host", ANCHOR)
def ag14_run(spark: SparkSession, d: str) -> DataFrame:
    """The report of a run over the pages of each host: how many were read with terms, without, or left out by their method, and the terms."""
    u = F.col("url")
    r = read(spark, d, "rkka").filter("url is not null and host is not null").select("page_id", "host", (V.parse_method(u, domain(u), F.col("status_code")) != "requests+bs4").alias("skipped"))
    r = r.join(voc1a(spark, d).groupBy("page_id").agg(F.count(F.lit(1)).alias("n")), "page_id", "left").withColumn("n", F.when(F.col("skipped"), 0).otherwise(F.coalesce("n", F.lit(0))))
    c = lambda e: F.count_if(F.expr(e))
    return r.groupBy("host").agg(F.count(F.lit(1)).alias("total"), c("not skipped and n > 0").alias("success"), c("not skipped and n = 0").alias("failed"), c("skipped").alias("skipped"), F.sum("n").alias("terms"))
