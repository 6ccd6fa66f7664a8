"""Problem 8: template residue, filler and error messages in place of content.

``documents`` has neither address nor title, so the words of ``source`` (its host
name) stand for the address slug, and the first line of a text for its title.

One pass over all texts, whole, cuts each into statements (clock marks and
captions taken off) and weighs them:

* placeholder detectors look at every statement;
* a trained term model (``train_residue``: word stems, letter trigrams, pairs of
  stems) gives each statement its log odds of being a message or filler against
  content, and of being site furniture; a statement that is surely content
  (beyond ``SURE``) settles its text;
* the words of informative texts are counted (document frequency over all rows).

What is left are texts of little information in which nothing is surely content.
Their statements are judged by combined evidence: the term model, the number of
texts and hosts that repeat the same words (figures masked), and the mismatch:
the share of the body's terms, weighted by rarity, that neither its title, nor
its slug, nor the informative texts of the hosts use.  A text is a case where a
placeholder stands in it, or where at least one statement is a message and all
others are messages or furniture.

Copies are counted by partial aggregates over (signature, document), and the
evidence goes back to the statements by a salted join, so one notice that a
third of all texts repeat is no hot task.

Defined results: null and blank texts are no cases; repeated rows give one row
and count as one text; a null source is no host; texts are read whole.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.spread import spread
from tapeloom.session import cut

#: Log odds of content from which on no evidence of copies can make a statement a message.
SURE = 3.0
#: Weight of one doubling of texts and hosts that repeat a statement, at full mismatch, and of the mismatch's middle.
REPEATED, MIDDLE = 1.4, 0.35
#: Texts from which on a statement counts as repeated in the reason given.
COPIES = 3
#: A text of so many different stems, one of its statements surely content, is informative: its words are the hosts' own.
INFORMATIVE = 12
#: Buckets of the term model, and words and pairs whose weights a worker keeps.
BUCKETS, KEEP = 1 << 16, 400_000
#: Salts of the join that brings the evidence back to the statements.
SALTS = 16

# Placeholders that templates leave, whatever stands around them.
_PLACEHOLDER = [
    r"\{\{[^{}\n]*\}\}", r"\{%[^{}\n]*%\}", r"\$\{[^{}\n]+\}", r"<%[^<>\n]*%>", r"\[\[[^\[\]\n]+\]\]",
    r"%\([A-Za-z_]\w*\)[sdrf]", r"(?<![\w%])%[A-ZА-ЯЁÄÖÜ][A-ZА-ЯЁÄÖÜ_]+%", r"(?<!\w)__[A-ZА-ЯЁÄÖÜ][A-ZА-ЯЁÄÖÜ_]*__(?!\w)", r"@@[\w ]+@@", r"(?<!#)##?[A-ZА-ЯЁÄÖÜ][A-ZА-ЯЁÄÖÜ_]+##?",
    r"(?<![XХ\w])[XХ]{4,}(?![XХ\w])", r"(?<!_)_{5,}", r"\[object \w+\]", r"(?<![\w.])NaN(?![\w.])",
    r"<(?!\|)(?:[A-ZА-ЯЁÄÖÜ]{3,}[A-ZА-ЯЁÄÖÜ _\-]*|(?:insert|your|enter|вставьте|укажите|введите|впишите|имя|hier|bitte)\b[^<>\n]*)>",
    r"&lt;[^&\n]{2,}&gt;",
    r"\[(?:ВСТАВ|ВПИШ|УКАЖ|ВВЕД|ИМЯ|ФИО|ФАМИЛ|НАЗВАНИЕ|ДАТА|МЕСТО|INSERT|ENTER|YOUR|NAME|DATE|PLACE|TITLE|UNIT|DATUM|ORT|EINHEIT|HIER)[^\[\]\n]*\]",
    r"\bTODO\b", r"(?<![\w{])\{(?:[A-Za-zА-Яа-яЁё]+[_.])*[A-Za-zА-Яа-яЁё]+\}",
]
# Signs that are placeholders only where the statement does not speak about them.
_DOUBTFUL = re.compile(r"(?<![\w%])%[sd](?!\w)|(?<![\w{])\{\d+\}|(?<!\w)undefined(?!\w)|(?<!\w)null(?!\w)")
_EXPLAINED = re.compile(r"вместо|означа|обознача|сноск|примечани|формул|instead of|stands? for|stood for|denot|footnote|formula|statt|bedeutet|(?:steht|stand) für|fußnote|formel", re.I)
# English and German words beside which "undefined" and "null" are words of the language.
_ADJECTIVE = re.compile(r"\b(?:left|leaves?|is|was|are|were|be|been|being|remain\w*|stay\w*|seem\w*|still|yet|an|the|so|as|otherwise|largely|and|or)\s+(?:\w+ly\s+)?undefined\b|\bundefined\s+(?:until|by|in|at|and|or|border\w*|area\w*|line\w*|role\w*|number\w*|period\w*|behaviou?r)\b", re.I)
_NUMERAL = re.compile(r"\bnull\s+(?:und|and|oder|or|uhr|grad|prozent|percent|komma|punkt|hypothes\w*|result\w*|set|value|vector|space|meter|kilometer|stunde\w*|mann)\b|\b(?:bei|auf|gegen|um|unter|über|gleich)\s+null\s*(?=[.,;:!?]|\b(?:uhr|grad)\b|$)", re.I)
_LAYOUT = re.compile(r"^\s*(?:\d{1,3}:\d{2}:\d{2}[.,\d]*:?\s*)?(?:[А-ЯЁA-ZÄÖÜ][\w\-]+:\s+)?")
_STATEMENT = re.compile(r"(?<=[.!?…])\s+|[\r\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = frozenset("{<[%_@#XХ$NTnu&")
_placeholder = re.compile("|".join(f"(?:{p})" for p in _PLACEHOLDER))
# Romanisation of Cyrillic letters, for host names.
_ROMAN = str.maketrans(dict(zip("абвгдеёзийклмнопрстуфыэ", "abvgdeeziyklmnoprstufye", strict=True)) | {"ж": "zh", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ю": "yu", "я": "ya", "ъ": "", "ь": ""})

CONTENT, MESSAGE, FURNITURE = range(3)


def stem(word: str) -> str:
    return word[:6]


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


class Terms:
    """The term model: weights of hashed features for (content, message, furniture), kept for each word and pair seen."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray) -> None:
        self.weights, self.bias = weights, bias
        self.words: dict[str, tuple[float, float, float]] = {}
        self.pairs: dict[tuple[str, str], tuple[float, float, float]] = {}

    @staticmethod
    @lru_cache(1)
    def load() -> Terms:
        raw = json.loads(resources.files("tapeloom.llm.models").joinpath("residue.json").read_text())
        weights = np.zeros((BUCKETS, 3), np.float32)
        weights[raw["at"]] = np.array(raw["w"], np.float32)
        return Terms(weights, np.array(raw["bias"], np.float32))

    @staticmethod
    def word_features(word: str) -> list[tuple[int, float]]:
        edged = f"^{word}$"
        grams = [edged[i : i + 3] for i in range(len(edged) - 2)]
        return [(_bucket("w " + stem(word)), 1.0), *((_bucket("g " + g), 1.0 / len(grams)) for g in grams)]

    @staticmethod
    def pair_features(a: str, b: str) -> list[tuple[int, float]]:
        return [(_bucket(f"p {stem(a)} {stem(b)}"), 1.0)]

    @staticmethod
    def shape_features(statement: str, words: list[str]) -> list[tuple[int, float]]:
        n = len(words)
        size = "0" if n == 0 else "1" if n == 1 else "2" if n == 2 else "3" if n < 6 else "6" if n < 11 else "11" if n < 21 else "21"
        out = [f"n {size}", f"last {statement[-1:] if not statement[-1:].isalnum() else 'a'}"]
        if "|" in statement or "»" in statement[-1:]:
            out.append("bar")
        if any(c.isdigit() for c in statement):
            out.append("figure")
        if n and len(set(words)) * 2 <= n:
            out.append("repeats")
        return [(_bucket("s " + f), 1.0) for f in out]

    def _sum(self, features: list[tuple[int, float]]) -> tuple[float, float, float]:
        v = sum((self.weights[k] * x for k, x in features), np.zeros(3, np.float32))
        return float(v[0]), float(v[1]), float(v[2])

    def score(self, statement: str, words: list[str]) -> tuple[float, float, float]:
        """Logits of content, message and furniture; a sum over words and pairs, over the root of their number."""
        c = m = f = 0.0
        get, before = self.words.get, None
        for w in words:
            x = get(w)
            if x is None:
                if len(self.words) >= KEEP:
                    self.words.clear()
                x = self.words[w] = self._sum(self.word_features(w))
            c, m, f = c + x[0], m + x[1], f + x[2]
            if before is not None:
                x = self.pairs.get((before, w))
                if x is None:
                    if len(self.pairs) >= KEEP:
                        self.pairs.clear()
                    x = self.pairs[before, w] = self._sum(self.pair_features(before, w))
                c, m, f = c + x[0], m + x[1], f + x[2]
            before = w
        root = math.sqrt(len(words)) or 1.0
        s = self._sum(self.shape_features(statement, words))
        return c / root + s[0] + float(self.bias[0]), m / root + s[1] + float(self.bias[1]), f / root + s[2] + float(self.bias[2])


def placeholder(statement: str) -> bool:
    """Whether an unfilled placeholder stands in a statement that does not speak about it."""
    if _SIGNS.isdisjoint(statement):
        return False
    if _placeholder.search(statement):
        return True
    if not _DOUBTFUL.search(statement) or _EXPLAINED.search(statement):
        return False
    left = _NUMERAL.sub(" ", _ADJECTIVE.sub(" ", statement))
    return _DOUBTFUL.search(left) is not None


def statements(text: str) -> list[str]:
    return [y for y in (_LAYOUT.sub("", x, count=1).strip() for x in _STATEMENT.split(text)) if y]


def _slug(source: str | None) -> set[str]:
    return {stem(w) for w in _WORD.findall((source or "").casefold().rpartition(".")[0])}


OUT = "doc_id bigint, source string, holder boolean, signature bigint, message double, furniture boolean, stems array<string>, term string, texts bigint"


def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, source, text) -> rows of placeholders, of statements in texts without sure content, and of term counts.

    A partition's term counts are given out whenever they hold KEEP terms, and at its end."""
    model = Terms.load()
    counts: Counter[str] = Counter()
    names = [x.split()[0] for x in OUT.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.float64(), pa.bool_(), pa.list_(pa.string()), pa.string(), pa.int64()], strict=True)))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def told() -> list[tuple]:
        out = [(None, None, None, None, None, None, None, k, v) for k, v in counts.items()]
        counts.clear()
        return out

    for b in batches:
        for at in range(0, b.num_rows, 1024):
            rows = []
            p = b.slice(at, 1024)
            for doc, source, text in zip(*(p.column(i).to_pylist() for i in range(3)), strict=True):
                if doc is None or text is None or not text.strip():
                    continue
                parts = statements(text)
                sure, seen, held = False, set(), False
                kinds = []
                for x in parts:
                    held = held or placeholder(x)
                    words = _WORD.findall(x.casefold())
                    seen.update(map(stem, words))
                    if not sure:  # one sure statement settles a text
                        c, m, f = model.score(x, words)
                        if max(m, f) < c - SURE:
                            sure = True
                        kinds.append((x, words, m - c, not words or f > m and f > c))
                if sure and len(seen) >= INFORMATIVE:
                    counts.update(seen)
                if held:
                    rows.append((doc, source, True, None, None, None, None, None, None))
                elif not sure:
                    # the terms that title and slug account for are no mismatch of the body
                    # (a body that only says its title again has nothing beside it to agree with)
                    title = set(map(stem, kinds[0][1]))
                    slug = _slug(source)
                    for i, (x, words, odds, furniture) in enumerate(kinds):
                        mine = set(map(stem, words))
                        agreed = {s for s in mine if s in slug or stem(s.translate(_ROMAN)) in slug} | (mine & title if mine != title else set())
                        sign = xxhash.xxh64_intdigest(re.sub(r"\d+", "0", x.casefold())) - (1 << 63)
                        rows.append((doc, source, False, sign, odds, furniture, sorted(mine - agreed), None, None))
            if len(counts) >= KEEP:
                rows += told()
            if rows:
                yield batch(rows)
    if counts:
        yield batch(told())


def evidence(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weighed rows, written once, and for each signature: texts, hosts, mismatch."""
    rows = spread(docs.select("doc_id", "source", "text")).mapInArrow(weigh, OUT)
    rows = cut(rows, "residue")
    said = rows.filter("signature is not null and not furniture")
    # texts and hosts that hold the same words: one partial aggregate by document, one by signature
    each = said.groupBy("signature", "doc_id").agg(F.max("source").alias("source"), F.min(F.struct(F.size("stems"), "stems")).alias("s"))
    signs = each.groupBy("signature").agg(F.count(F.lit(1)).alias("texts"), F.approx_count_distinct("source", 0.02).alias("hosts"), F.min("s")["stems"].alias("stems"))
    terms = rows.filter("term is not null").groupBy("term").agg(F.sum("texts").alias("df"))
    # rare terms weigh more; a term that one informative text alone uses is nobody's
    open_ = signs.select("signature", F.explode("stems").alias("term")).join(terms, "term", "left")
    rarity = 1.0 / F.log2(F.lit(4.0) + F.coalesce("df", F.lit(0)))
    strange = open_.groupBy("signature").agg((F.sum(F.when(F.coalesce("df", F.lit(0)) < 2, rarity).otherwise(0.0)) / F.sum(rarity)).alias("mismatch"))
    return rows, signs.drop("stems").join(strange, "signature", "left").withColumn("mismatch", F.coalesce("mismatch", F.lit(0.0)))


def residue(docs: DataFrame) -> DataFrame:
    """doc_id, reason of the cases: placeholder, message (by its terms alone), repeated (the evidence of the hosts speaks for it too)."""
    rows, signs = evidence(docs)
    salted = signs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    stated = rows.filter("signature is not null").select("doc_id", "signature", "message", "furniture", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    judged = stated.join(salted, ["signature", "salt"], "left")
    repeats = F.lit(REPEATED) * (F.col("mismatch") - MIDDLE) * (F.log2("texts") + F.log2(F.greatest("hosts", F.lit(1)))) / 2
    lifted = F.col("message") + F.greatest(F.coalesce(repeats, F.lit(0.0)), F.lit(0.0))
    backed = (F.col("texts") >= COPIES) & (repeats > 0)
    kind = F.when(F.col("furniture"), "f").when(lifted <= 0, "c").when(backed, "r").otherwise("m")
    judged = judged.select("doc_id", kind.alias("kind"))
    holders = rows.filter("holder").select("doc_id", F.lit("p").alias("kind"))
    count = lambda k: F.count_if(F.col("kind") == k)
    sums = judged.unionByName(holders).groupBy("doc_id").agg(*[count(k).alias(k) for k in "pmrc"])
    reason = F.when(F.col("p") > 0, "placeholder").when(F.col("c") > 0, None).when(F.col("r") > 0, "repeated").when(F.col("m") > 0, "message")
    return sums.select("doc_id", reason.alias("reason")).filter("reason is not null")


def p8_reasons(spark: SparkSession, d: str) -> DataFrame:
    return residue(spark.read.parquet(f"{d}/documents.parquet"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_reasons(spark, d).select("doc_id")


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """The documents without the cases, null and blank texts included."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.join(p8_found(spark, d), "doc_id", "left_anti").select("doc_id", "lang", "source", "n_chars")

