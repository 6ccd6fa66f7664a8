"""Predicates and rewrites on terms and addresses, as Columns, and the fuzzy join of words."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import lexicon as X

U = "(?U)"


def words(t: Column) -> Column:
    return F.split(t, " ")


def _in(c: Column, values: list[str]) -> Column:
    return c.isin(*values)


def useful_latin(t: Column) -> Column:
    return (
        F.when(~t.rlike(r"^[A-Za-z0-9\s\-.]+$"), False)
        .when(t.rlike(r"^[0-9\s,\-–]+$"), False)
        .when(t.rlike("[0-9]") & t.rlike("[A-Za-z]"), True)
        .when(t.rlike(r"(?:^|[^\p{L}\p{N}_])[IVX]+$"), True)
        .otherwise((F.size(words(t)) == 1) & (F.length(t) <= 20))
    )


def cyrillic_term(t: Column) -> Column:
    return t.rlike("[А-ЯЁа-яё]{2,}")


def looks_like_person(t: Column) -> Column:
    return ((F.size(words(t)) >= 2) | t.rlike(r"[А-ЯЁ]\.")) & t.rlike("^[А-ЯЁ]") & ~words(t)[0].rlike("^[А-ЯЁ]{5,}$")


def stopword_term(t: Column) -> Column:
    return (F.size(words(t)) == 1) & _in(F.lower(t), X.STOP)


def genitive_fragment(t: Column) -> Column:
    first = F.lower(words(t)[0])
    country = _in(first, X.COUNTRIES)
    second = F.coalesce(_in(F.lower(F.get(words(t), F.lit(1))), X.VERB_MARKS), F.lit(False))
    return (
        F.when(F.size(words(t)) == 1, False)
        .when(first.rlike(f"({'|'.join(X.GENITIVE)})$") & ~country, True)
        .when(country & second, True)
        .when(first.rlike("^[0-9]+-го"), True)
        .otherwise(F.exists(words(F.lower(t)), lambda x: x.rlike("(ого|его)$")))
    )


def english_date(t: Column) -> Column:
    return reduce(or_, [t.rlike("(?iuU)" + p) for p in X.ENGLISH_DATE])


def valid_term(t: Column) -> Column:
    stop = [*X.STOP, *X.STOP_TEMPLATES]
    rejected = reduce(or_, [t.rlike(("(?iuU)" if "напомнил" in p else U) + p) for p in X.REJECT]) | english_date(t)
    some = F.exists(words(F.lower(t)), lambda x: ~_in(x, stop))
    return F.length(t).between(3, 100) & ~rejected & ~_in(F.lower(t), stop) & ~_in(F.lower(words(t)[0]), X.STARTERS) & ~genitive_fragment(t) & (F.size(words(t)) <= 8) & some


def proper_noun(t: Column) -> Column:
    return t.rlike(r"^\p{Lu}") | t.rlike(r"^[0-9]\S*\s+\p{Lu}")


def military_rank(t: Column) -> Column:
    return _in(F.lower(words(t)[0]), X.RANKS) & F.coalesce(F.get(words(t), F.lit(1)).rlike(r"^\p{Lu}"), F.lit(False))


def military_unit(t: Column) -> Column:
    return t.rlike("(?iu)" + X.UNIT)


def technical(t: Column) -> Column:
    return t.rlike(X.TECHNICAL)


def abbreviation(t: Column) -> Column:
    return t.rlike(r"^\p{Lu}{1,4}$") & ~_in(F.lower(t), X.WHITE_STOP)


def toponym(t: Column) -> Column:
    return t.rlike(r"^\p{Lu}") & F.lower(t).rlike(f"({'|'.join(X.TOPONYM)})$")


def verb_inside(t: Column) -> Column:
    return reduce(or_, [t.rlike("(?iuU)" + p) for p in X.VERBS_INSIDE])


def sentence_fragment(t: Column) -> Column:
    return (F.size(words(t)) > 5) | verb_inside(t)


def reject_reason(t: Column) -> Column:
    return F.when(english_date(t), "english date").when(genitive_fragment(t), "genitive").when(~valid_term(t), "not valid").otherwise("kept")


def white_list(t: Column) -> Column:
    return F.when(_in(F.lower(t), X.WHITE_STOP), "stop").when(sentence_fragment(t), "fragment").when(military_unit(t), "unit").when(proper_noun(t), "proper").when(military_rank(t), "rank").otherwise("other")


def normalize_caps(t: Column) -> Column:
    one = lambda x: F.when(x.rlike(r"^\p{Lu}{5,}$"), F.concat(F.substring(x, 1, 1), F.lower(F.substr(x, F.lit(2))))).otherwise(x)
    return F.array_join(F.transform(words(t), one), " ")


def clean_term(t: Column) -> Column:
    """Entities, references, brackets without a Latin name, dashes and quotes go; white space is squeezed."""
    for p, to in ((r"&\w+;|&#\d+;", " "), (r"\[[^\]]*\]", ""), (r"\([^A-Za-z)][^)]*\)", ""), (r"\s[—–-]\s", " "), (r"[«»\"]|\s+", " ")):
        t = F.regexp_replace(t, p, to)
    return F.btrim(F.trim(t), F.lit(".,;: "))


def normalize_case(t: Column) -> Column:
    """TX15: the rules of the table one after the other, without regard to case."""
    for p, to in X.CASE_ENDINGS:
        t = F.regexp_replace(t, "(?iuU)" + p, to.replace("\\1", "$1"))
    return F.trim(t)


def normalize_term(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def parse_method(url: Column, domain: Column, status: Column) -> Column:
    """The decision table of an audit; the first rule that fits decides."""
    return (
        F.when(url.rlike(r"[$][{]"), "manual").when(_in(domain, X.MANUAL_DOMAINS), "manual").when(_in(domain, X.API_DOMAINS), "api").when(status.isNull(), "dead").when(status.isin(404, 410), "dead")
        .when(status.isin(401, 403), "manual").when(status >= 500, "dead").when(_in(domain, X.JS_DOMAINS), "selenium").when(status == 200, "requests+bs4").otherwise("manual")
    )


def priority(domain: Column) -> Column:
    return F.when(_in(domain, X.PRIORITY_HIGH), "HIGH").when(_in(domain, X.PRIORITY_MED), "MED").otherwise("LOW")


def fuzzy_pairs(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """(w, v, dist): words within ``most`` (1 or 2) edits.

    Two words within two edits share a writing with at most two letters left
    out, so both sides meet in an equi join on those writings; the exact
    distance decides.
    """

    def without(c: str) -> Column:
        drop = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substr(x, F.lit(1), i - 1), F.substr(x, i + 1)))
        one = F.array_union(F.array(F.col(c)), drop(F.col(c)))
        return F.explode(F.array_distinct(one if most == 1 else F.flatten(F.transform(one, lambda x: F.array_union(F.array(x), drop(x))))))

    a, b = left.withColumn("k", without("w")), right.withColumn("k", without("v"))
    pairs = a.join(b, "k").select("w", "v").distinct()
    return pairs.withColumn("dist", F.levenshtein("w", "v")).filter(F.col("dist") <= most)


# correctors: tokens of texts against the words of the dictionary

# Cyrillic letters and what they are written as for distances counted in single signs.
LETTERS = ("абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "abvgdeejzijklmnoprstufhc1234567890")
VOWELS, VOICED, VOICELESS = "аеёиоуыэюяaeiouyäöü", "бдгвbdgv", "пткфptkf"


def phonetic_key(word: Column) -> Column:
    """VOC12: lower case, soft and hard signs gone, vowels after the first letter gone, voiced consonants as voiceless ones."""
    low = F.translate(F.lower(word), "ьъ", "")
    return F.translate(F.concat(F.substring(low, 1, 1), F.regexp_replace(F.substring(low, F.lit(2), F.length(low)), f"[{VOWELS}]", "")), VOICED, VOICELESS)


def best_of(pairs: DataFrame, by: list[str]) -> DataFrame:
    """The candidate that corrects a word: the greatest weight, then the least distance, then the longest, then the first by its letters."""
    rank = F.struct((-F.col("weight")).alias("a"), F.col("dist").alias("b"), (-F.length("v")).alias("c"), F.col("v").alias("d"))
    return pairs.groupBy(*by).agg(F.min_by(F.struct("v", "dist", "weight"), rank).alias("x")).select(*by, "x.v", "x.dist", "x.weight")
