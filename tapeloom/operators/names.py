"""Who speaks: unevenly written speaker labels resolved to canonical names.

Everything is a Column expression, so the work stays in the JVM.  The only join
is with the (file_id, tape_no) dimension; it is salted because one recording
may hold a third of all rows.

Defined results: a null, blank, question-mark or dash label defers to the raw
id; a label that names nobody of the recording is ``Неизвестно``; a segment
whose tape is not described resolves roles and aliases but no surname.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOURNALIST, OPERATOR, UNKNOWN, EXPERT_ROLE = "Журналист", "Оператор", "Неизвестно", "Спикер"

#: Up to so many aliases become literals of the expression; a longer table is joined as one row instead, to the same result.
MAX_ALIASES = 5000

# Cyrillic capitals that look like Latin ones.
_LOOKALIKE = ("АВЕКМНОРСТУХЁ", "ABEKMHOPCTYXE")
# Romanisation of Cyrillic letters.
_ROMAN_ONE = ("АБВГДЕЗИЙКЛМНОПРСТУФЫЭ", "ABVGDEZIYKLMNOPRSTUFYE")
_ROMAN_MANY = {"Щ": "SHCH", "Ж": "ZH", "Х": "KH", "Ц": "TS", "Ч": "CH", "Ш": "SH", "Ю": "YU", "Я": "YA", "Ё": "YO", "Ъ": "", "Ь": ""}

_BLANK = r"^[\s ​﻿?？\-‐‑‒–—―−]*$"
_RAW = r"^(?:SPEAKER|SPKR|SPK|CПИKEP|SPRECHER) ?0*([0-9]+)$"


def skeleton(c: Column) -> Column:
    """Upper case, look-alike letters unified, everything but letters and digits as single spaces."""
    return F.trim(F.regexp_replace(F.translate(F.upper(c), *_LOOKALIKE), r"[^\p{L}\p{N}]+", " "))


def romanised(c: Column) -> Column:
    x = F.upper(c)
    for a, b in _ROMAN_MANY.items():
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(F.translate(x, *_ROMAN_ONE), r"[^\p{L}\p{N}]+", " "))


def one_slip(a: Column, b: Column) -> Column:
    """True where a and b (five letters or more) differ by one edit or one swap of neighbours."""
    swap = (F.length(a) == F.length(b)) & (F.levenshtein(a, b, 2) == 2) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (F.length(b) >= 5) & (F.abs(F.length(a) - F.length(b)) <= 1) & ((F.levenshtein(a, b, 1) >= 0) | swap)


def _skeleton_py(s: str) -> str:
    import re

    return re.sub(r"[\W_]+", " ", s.upper().translate(str.maketrans(*_LOOKALIKE))).strip()


def load_aliases(aliases: DataFrame) -> dict[str, str] | None:
    """The alias dictionary on the driver: skeleton of the alias -> role; None where it holds more than MAX_ALIASES rows."""
    rows = aliases.select("alias", "role_name").filter("alias is not null and role_name is not null").limit(MAX_ALIASES + 1).collect()
    return None if len(rows) > MAX_ALIASES else {_skeleton_py(a): r for a, r in rows}


def with_aliases(rows: DataFrame, aliases: DataFrame) -> tuple[DataFrame, Column, Column]:
    """rows, the skeletons of all aliases, and the map from them to roles: literals, or columns of a joined row."""
    known = load_aliases(aliases)
    if known is None:
        own = aliases.filter("alias is not null and role_name is not null").groupBy(skeleton(F.col("alias")).alias("a")).agg(F.max("role_name").alias("r"))
        return rows.join(F.broadcast(own.agg(F.map_from_entries(F.collect_list(F.struct("a", "r"))).alias("_lookup")))), F.map_keys("_lookup"), F.col("_lookup")  # one row
    if not known:
        return rows, F.array().cast("array<string>"), F.lit(None).cast("map<string,string>")
    return rows, F.array(*[F.lit(a) for a in known]), F.create_map(*[x for a, r in known.items() for x in (F.lit(a), F.lit(r))])


def tape_dimension(audio_files: DataFrame, speaker_roles: DataFrame) -> DataFrame:
    """One row per tape: the expert's surname in three writings and the map of raw labels to roles."""
    roles = (
        speaker_roles.filter("label is not null and role_name is not null")
        .groupBy("file_id", "tape_no", "label")
        .agg(F.max("role_name").alias("role_name"))
        .groupBy("file_id", "tape_no")
        .agg(F.map_from_entries(F.collect_list(F.struct("label", "role_name"))).alias("_roles"))
    )
    tapes = audio_files.groupBy("file_id", "tape_no").agg(F.max("surname").alias("_surname"), F.max("given_name").alias("_given"))
    return tapes.join(roles, ["file_id", "tape_no"], "full_outer").select(
        "file_id",
        "tape_no",
        "_surname",
        skeleton(F.col("_surname")).alias("_sur"),
        romanised(F.col("_surname")).alias("_lat"),
        skeleton(F.col("_given")).alias("_giv"),
        "_roles",
    )


def _role_of(role: Column) -> Column:
    return F.when(role == EXPERT_ROLE, F.col("_surname")).otherwise(role)


def _named(label: Column, t: Column, words: Column, lookup: Column) -> Column:
    """The name a label stands for; null where the label says nothing."""
    tokens = F.split(t, " ")
    sur, lat = F.col("_sur"), F.col("_lat")
    number = F.regexp_extract(t, _RAW, 1)
    raw = F.coalesce(F.element_at(F.col("_roles"), F.concat(F.lit("SPEAKER_"), F.lpad(number, 2, "0"))), F.lit(UNKNOWN))
    has = lambda word: F.array_contains(tokens, word)
    # Short forms of the roles, as skeletons.
    journalist = t.rlike(r"(^| )(ЖYPHAЛИCT|ZHURNALIST)") | t.rlike(r"^(Ж|ЖYP|ЖYPH|ЖYPHAЛ|Ж ?T|ЖYP ?T|KOPP|KOP|KOPPECП|ИHT|ИHTEPB|INT|BEД|PEП|PEПOPT|ZHURN)$")
    operator = t.rlike(r"(^| )OПEPATOP") | t.rlike(r"^(OП|OПEP|OПEPAT|KAM|OP|OPER)$")
    word = F.filter(tokens, lambda x: F.array_contains(words, x))
    slipped = F.filter(words, lambda a: one_slip(t, a))
    return (
        F.when(label.isNull() | label.rlike(_BLANK), F.lit(None).cast("string"))
        .when(has(sur) | (t == sur), F.col("_surname"))
        .when(t == JOURNALIST_SK, JOURNALIST)
        .when(t == OPERATOR_SK, OPERATOR)
        .when(t.rlike(_RAW), raw)
        .when(F.array_contains(words, t), _role_of(F.element_at(lookup, t)))
        .when(journalist, JOURNALIST)
        .when(operator, OPERATOR)
        .when(t.rlike(r"^(UNKNOWN|HEИЗBECTH|HEИЗB|HEИЗ|UNBEKANNT)"), UNKNOWN)
        .when(has(lat) | (t == lat), F.col("_surname"))
        .when((F.length(t) >= 3) & (F.startswith(sur, t) | F.startswith(lat, t)), F.col("_surname"))
        .when(t == F.col("_giv"), F.col("_surname"))
        .when(F.size(word) > 0, _role_of(F.element_at(lookup, word[0])))
        .when(one_slip(t, sur) | one_slip(t, lat), F.col("_surname"))
        .when(one_slip(t, F.lit(JOURNALIST_SK)) | one_slip(t, F.lit("ZHURNALIST")), JOURNALIST)
        .when(one_slip(t, F.lit(OPERATOR_SK)), OPERATOR)
        .when(F.size(slipped) > 0, _role_of(F.element_at(lookup, slipped[0])))
        .when(F.exists(tokens, lambda x: one_slip(x, sur) | ((F.length(x) >= 4) & F.startswith(sur, x))), F.col("_surname"))
        .otherwise(UNKNOWN)
    )


JOURNALIST_SK, OPERATOR_SK = _skeleton_py(JOURNALIST), _skeleton_py(OPERATOR)


def resolve_names(segments: DataFrame, audio_files: DataFrame, speaker_roles: DataFrame, role_aliases: DataFrame, name: str = "name", salts: int = 16, surname: str | None = None) -> DataFrame:
    """Adds ``name`` (and the expert's ``surname``, if asked for) to segments (which need file_id, tape_no, speaker, raw_speaker_id).

    The dimension is repeated ``salts`` times so that the rows of one tape are
    spread over as many tasks; Spark broadcasts it instead where its measured
    size allows.
    """
    dim = tape_dimension(audio_files, speaker_roles).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = segments.withColumn("_salt", F.pmod(F.xxhash64("start_us", "speaker", "raw_speaker_id", "end_us"), F.lit(salts)).cast("int"))
    rows, words, lookup = with_aliases(rows.join(dim, ["file_id", "tape_no", "_salt"], "left"), role_aliases)
    rows = rows.withColumns({"_t": skeleton(F.col("speaker")), "_r": skeleton(F.col("raw_speaker_id"))})
    rows = rows.withColumn("_by_label", _named(F.col("speaker"), F.col("_t"), words, lookup))
    by_raw = F.when(F.col("_by_label").isNull(), _named(F.col("raw_speaker_id"), F.col("_r"), words, lookup))
    if surname:
        rows = rows.withColumn(surname, F.col("_surname"))
    return rows.withColumn(name, F.coalesce("_by_label", by_raw, F.lit(UNKNOWN))).drop("_salt", "_t", "_r", "_by_label", "_surname", "_sur", "_lat", "_giv", "_roles", "_lookup")
