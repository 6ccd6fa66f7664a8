"""Problem 4: speech transcripts into clean, ordered speaker turns.

Every text is cut into tokens.  A linear-chain model with trained weights
(``train_turns``) scores the labels speech, clock mark, sound note, hesitation
or filler, caption and punctuation of each token from what it is (its word, its
ending and beginning, the form of its letters), from its neighbours, from the
brackets or signs it stands between and how many words they hold, from whether
anything was said before it, and from the language of the text; Viterbi decoding
finds the best labelling of a whole batch of texts at once.  No list decides
what may be a sound or a filler: a word that training never saw is labelled by
its form and its place.  Turns are assembled from what is speech: consecutive
segments of one person, without a pause that changes the session, are one turn.

Defined results: null text is a segment without speech; rows without a usable
time are labelled like all others but take no part in the order of turns; long
texts are read whole; repeated deliveries count once (the latest).
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.ordered import with_islands
from tapeloom.operators.speech_periods import GAP_AT_MOST_US, named_segments, valid_segments
from tapeloom.session import cut

LABELS = ("speech", "timestamp", "sound", "filler", "head", "punct")
SPEECH, TIMESTAMP, SOUND, FILLER, HEAD, PUNCT = range(6)

# Tokens of a transcript, in the order in which they are tried.
TOKEN = re.compile(
    r"""\[нрзб\]|\#\d\d-\d\d-\d\d\#|[\[<(]\d{1,3}:\d\d(?::\d\d)?(?:[.,]\d+)?[\])>]|\d{1,3}:\d\d:\d\d(?:[.,]\d+)?|\d{1,2}:\d\d(?!\d)|-->|>>+|\.\.+|…|\(\(|\)\)|[^\W_]+(?:[-'’.,][^\W_]+)*|[^\w\s]|_"""
)
_NUMBER = re.compile(r"\d+(?:[.,]\d+)?\Z")
# Words that mean different things by their neighbours; they are contexts of their own.
WORDS = "ну вот короче типа значит понимаете как бы так сказать скажем это самое в общем собственно знаете видите ли also halt quasi sozusagen na ja sag ich mal sagen wir irgendwie weißt du wissen sie like well you know i mean sort of kind basically actually to speak что ни почему uhr утра к gegen at um er мм а и".split()
SIGNS = [",", ".", "...", "?", "!", ":", ";", "—", "–", "-", ">>", "-->", "(", ")", "[", "]", "{", "}", "<", ">", "/", "*", "♪", "((", "))", "#", "|", '"', "«", "»"]
SHAPES = ["<edge>", "<word>", "<Word>", "<number>", "<clock>", "<bracket-clock>", "<hash-clock>", "<hour>", "<nrzb>", "<role>", "<name>", "<other>"]
SYMBOLS = {s: i for i, s in enumerate([*SHAPES, *SIGNS, *(f"w:{w}" for w in dict.fromkeys(WORDS))])}
EDGE, NAME, ROLE = SYMBOLS["<edge>"], SYMBOLS["<name>"], SYMBOLS["<role>"]
#: What a token is, for the tables of brackets; signs, words, words with a capital, capitals alone, numbers, marks, names.
SIGN, LOWER, CAPITAL, CAPS, NUMBER, MARK, WHO = range(7)
# What opens and closes a note; the last three open and close with one sign.
PAIRS = [("[", "]"), ("(", ")"), ("{", "}"), ("<", ">"), ("((", "))"), ("/", "/"), ("*", "*"), ("♪", "♪")]
#: Brackets: none, or a pair by the number of words in it (1, 2, 3, more).
PLACES = 1 + 4 * len(PAIRS)
# Words by which German and English texts are told apart.
_GERMAN, _ENGLISH = set("der die das und ich ist nicht den dem ein eine wir sie es von mit auf für war wie was bitte im zu".split()), set("the and of to was that is we it for with on by you they had his from what who how why when where many near next back please tell us not without".split())
OTHER, GERMAN, ENGLISH = range(3)
#: Buckets of words, endings, beginnings and forms, so many of each token; tokens that a worker keeps.
LEXICON, PARTS, KEEP = 1 << 14, 4, 200_000


def symbol(token: str) -> int:
    c = token[0]
    if c.isdigit():
        return SYMBOLS["<clock>" if token.count(":") == 2 else "<hour>" if ":" in token else "<number>" if _NUMBER.match(token) else "<word>"]
    if c in "[<(#" and len(token) > 2:
        return SYMBOLS["<nrzb>" if token == "[нрзб]" else "<hash-clock>" if c == "#" else "<bracket-clock>"]
    if not c.isalnum():
        return SYMBOLS["..."] if token in ("…", "..") or token.startswith("...") else SYMBOLS[">>"] if token.startswith(">>") else SYMBOLS.get(token, SYMBOLS["<other>"])
    low = token.lower()
    if low in ("журналист", "оператор"):
        return ROLE
    return SYMBOLS.get(f"w:{low}") or SYMBOLS["<Word>" if c.isupper() else "<word>"]


def kind(token: str, sym: int) -> int:
    if sym in (NAME, ROLE):
        return WHO
    c = token[0]
    if c.isdigit() or not c.isalnum():
        return NUMBER if sym == SYMBOLS["<number>"] else SIGN if not c.isdigit() and len(token) <= 3 else MARK
    return CAPS if len(token) > 1 and token.isupper() else CAPITAL if c.isupper() else LOWER


def parts(token: str) -> list[int]:
    """Buckets of a token's word, ending, beginning and the form of its letters."""
    low = token.lower()
    if not low[0].isalpha():
        return [0] * PARTS
    letters = low.replace("-", "")
    drawn = re.sub(r"(.)\1+", r"\1", letters)
    form = f"{min(len(letters), 8)} {min(len(drawn), 5)} {min(len(set(letters)), 5)} {'-' in low} {not re.search('[аеёиоуыэюяaeiouyäöü]', low)} {not re.search('[^аеёиоуыэюяaeiouyäöühм-]', low)}"
    return [1 + zlib.crc32(x.encode()) % (LEXICON - 1) for x in (f"w {low}", f"e {low[-3:]}", f"b {low[:4]}", f"f {form}")]


class Tokens:
    """The tokens a worker has seen, by number: symbol, kind, parts and the sum of their weights."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.symbol, self.kind, self.parts, self.weight = np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros((0, PARTS), np.int64), np.zeros((0, len(LABELS)), np.float32)

    def numbers(self, texts: list[list[str]], lexicon: np.ndarray | None = None) -> np.ndarray:
        if len(self.number) > KEEP:
            self.__init__()
        get, new = self.number.get, []
        out = []
        for tokens in texts:
            for t in tokens:
                k = get(t)
                if k is None:
                    k = self.number[t] = len(self.number)
                    new.append(t)
                out.append(k)
        if new:
            syms = [symbol(t) for t in new]
            found = np.array([parts(t) for t in new], np.int64)
            self.symbol = np.concatenate((self.symbol, np.array(syms, np.int64)))
            self.kind = np.concatenate((self.kind, np.array([kind(t, s) for t, s in zip(new, syms, strict=True)], np.int8)))
            self.parts = np.concatenate((self.parts, found))
            if lexicon is not None:
                self.weight = np.concatenate((self.weight, lexicon[found].sum(1)))
        return np.array(out, np.int64)


class Seen:
    """What the model sees of texts that lie one after the other: a row for each token."""

    def __init__(self, texts: list[list[str]], names: list[str | None], known: Tokens, lexicon: np.ndarray | None = None) -> None:
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        number = known.numbers(texts, lexicon)
        self.symbol, self.kind, self.parts = known.symbol[number], known.kind[number], known.parts[number]
        self.weight = known.weight[number] if lexicon is not None else None
        n = len(number)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        at = 0
        for tokens, name in zip(texts, names, strict=True):
            if name:
                low, long = name.lower(), len(name)
                for i, t in enumerate(tokens):
                    if len(t) == long and t.lower() == low:
                        self.symbol[at + i], self.kind[at + i] = NAME, WHO
            at += len(tokens)
        text = np.repeat(np.arange(len(texts)), self.sizes)
        self.place = np.zeros(n, np.int64)
        worded = np.concatenate(([0], np.cumsum(self.kind != SIGN)))
        for k, (a, b) in enumerate(PAIRS):
            opens, closes = np.flatnonzero(self.symbol == SYMBOLS[a]), np.flatnonzero(self.symbol == SYMBOLS[b])
            if not len(opens) or not len(closes):
                continue
            if a == b:  # every second one of a text closes
                rank = np.arange(len(opens)) - np.searchsorted(opens, self.starts[text[opens]])
                opens, to = opens[:-1][(rank[:-1] % 2 == 0) & (rank[1:] % 2 == 1)], opens[1:][(rank[:-1] % 2 == 0) & (rank[1:] % 2 == 1)]
            else:
                following = np.searchsorted(closes, opens)
                opens = opens[following < len(closes)]
                to = closes[following[following < len(closes)]]
            same = text[opens] == text[to] if len(opens) else np.zeros(0, bool)
            for i, j in zip(opens[same].tolist(), to[same].tolist(), strict=True):
                words = int(worded[j] - worded[i + 1])
                if words and not self.place[i : j + 1].any():
                    self.place[i : j + 1] = 1 + 4 * k + min(words, 4) - 1
        # nothing but marks, notes and signs before it: the opening of a text, up to its first word outside brackets
        saying = (self.place == 0) & np.isin(self.kind, (LOWER, CAPITAL, CAPS, NUMBER, WHO))
        spoken = np.concatenate(([0], np.cumsum(saying)))
        self.opening = ((spoken[:-1] - spoken[self.starts[text]]) == 0).astype(np.int64) if n else np.zeros(0, np.int64)
        low = [{t.lower() for t in tokens} for tokens in texts]
        german, english = np.array([len(x & _GERMAN) for x in low], np.int64), np.array([len(x & _ENGLISH) for x in low], np.int64)
        self.language = np.where(german > english, GERMAN, np.where(english > 0, ENGLISH, OTHER))[text] if n else np.zeros(0, np.int64)
        full = self.sizes > 0
        self.before, self.after = np.concatenate(([EDGE], self.symbol[:-1]))[:n], np.concatenate((self.symbol[1:], [EDGE]))[:n]
        self.before[self.starts[full]] = EDGE
        self.after[self.ends[full] - 1] = EDGE


# The weight tables and what they are indexed by.
TABLES = ("own", "left", "right", "step", "place", "open", "tongue", "lexicon")


class Model:
    """Weights of the chain for each label: symbols, their neighbours, places in brackets, openings, languages, lexicon; step[label, label]."""

    def __init__(self, **tables: np.ndarray) -> None:
        for k in TABLES:
            setattr(self, k, tables[k])

    @staticmethod
    def empty() -> Model:
        s, n = len(SYMBOLS), len(LABELS)
        shapes = {"own": (s,), "left": (s, s), "right": (s, s), "step": (n,), "place": (PLACES, 7), "open": (s, 2), "tongue": (s, 3), "lexicon": (LEXICON,)}
        return Model(**{k: np.zeros((*v, n), np.float32) for k, v in shapes.items()})

    @staticmethod
    @lru_cache(1)
    def load() -> Model:
        raw = json.loads(resources.files("tapeloom.llm.models").joinpath("turns.json").read_text())
        m = Model.empty()
        if raw["symbols"] != list(SYMBOLS):
            raise ValueError("models/turns.json is of other symbols; train it anew")
        for k, x in raw["weights"].items():
            np.put(getattr(m, k), x["at"], x["w"])
        return m

    def dump(self) -> str:
        flat = {k: getattr(self, k).ravel() for k in TABLES}
        return json.dumps({"symbols": list(SYMBOLS), "weights": {k: {"at": np.flatnonzero(v).tolist(), "w": [round(float(x), 2) for x in v[np.flatnonzero(v)]]} for k, v in flat.items()}}, ensure_ascii=False, separators=(",", ":"))

    def scores(self, x: Seen) -> np.ndarray:
        s = x.symbol
        words = x.weight if x.weight is not None else self.lexicon[x.parts].sum(1)
        return self.own[s] + self.left[s, x.before] + self.right[s, x.after] + self.place[x.place, x.kind] + self.open[s, x.opening] + self.tongue[s, x.language] + words

    def decode(self, score: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The labels of all tokens of texts that lie one after the other: Viterbi over many texts at once."""
        out = np.empty(len(score), np.int8)
        if not len(score):
            return out
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        n = int((sizes > 0).sum())
        longest = int(sizes[order[0]])
        first, size = starts[order[:n]], sizes[order[:n]]
        back = np.empty((len(score), len(LABELS)), np.int8)
        best = score[first].copy()
        final = np.empty((n, len(LABELS)), np.float32)
        alive = n
        for t in range(1, longest + 1):
            still = int(np.searchsorted(-size, -t, side="left"))  # texts longer than t
            final[still:alive] = best[still:alive]
            alive = still
            if not alive:
                break
            ways = best[:alive, :, None] + self.step[None]
            how = ways.argmax(1)
            at = first[:alive] + t
            back[at] = how
            best = np.take_along_axis(ways, how[:, None, :], 1)[:, 0, :] + score[at]
        label = final.argmax(1)
        for t in range(longest - 1, -1, -1):
            k = int(np.searchsorted(-size, -t, side="left"))
            at = first[:k] + t
            label_k = label[:k]
            out[at] = label_k
            if t:
                label[:k] = back[at, label_k]
        return out


_known = Tokens()


def _labelled(texts: list[str | None], names: list[str | None], model: Model) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    tokens = [TOKEN.findall(x) if x else [] for x in texts]
    x = Seen(tokens, names, _known, model.lexicon)
    return tokens, x.sizes, model.decode(model.scores(x), x.sizes)


def mask_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seg_id, surname, differs, text) -> seg_id, mask: bits of LABELS that occur, bit 0 the label kind, bit 6 no speech."""
    model = Model.load()
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            p = b.slice(at, 2048)
            _, sizes, labels = _labelled(p.column(3).to_pylist(), p.column(1).to_pylist(), model)
            bits = np.zeros(len(sizes), np.int32)
            full = np.flatnonzero(sizes)
            if len(full):
                bits[full] = np.bitwise_or.reduceat(np.left_shift(1, labels.astype(np.int32)), (np.cumsum(sizes) - sizes)[full])
            silent = (bits & 1) == 0
            bits = (bits & 0b11110) | np.asarray(p.column(2).to_numpy(zero_copy_only=False), np.int32) | (silent.astype(np.int32) << 6)
            yield pa.RecordBatch.from_arrays([p.column(0), pa.array(bits, pa.int32())], ["seg_id", "mask"])


def _join(tokens: list[str]) -> str:
    """Spoken tokens as running text: no blank before closing signs, none of the commas that the removed words left."""
    out = ""
    for t in tokens:
        if t in (",", ".", "?", "!", ":", ";", ")", "]", "...", "…", "»"):
            if not out or out[-1] in ",;:(" or (out[-1] in ".?!" and t != "..."):
                continue
            out += t
        else:
            out += t if not out or out[-1] in "([«" else " " + t
    return out.strip(" ,;:—-")


def clean_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(surname, text, other columns) -> other columns, spoken: the words that were said; segments without any are left out."""
    model = Model.load()
    for b in batches:
        for at in range(0, b.num_rows, 2048):
            p = b.slice(at, 2048)
            tokens, _, labels = _labelled(p.column(1).to_pylist(), p.column(0).to_pylist(), model)
            out, i = [], 0
            for t in tokens:
                mine = labels[i : i + len(t)]
                i += len(t)
                out.append(_join([x for x, k in zip(t, mine, strict=True) if k in (SPEECH, PUNCT)]) if (mine == SPEECH).any() else None)
            spoken = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([*p.columns[2:], spoken], [*p.schema.names[2:], "spoken"]).filter(spoken.is_valid())


def _segments(spark: SparkSession, d: str) -> DataFrame:
    rows = valid_segments(spark, d, ["file_id", "tape_no", "start_us", "end_us", "speaker", "raw_speaker_id", "text"])
    rows = named_segments(spark, d, rows, surname="surname")
    return rows.withColumn("differs", ~F.col("speaker").eqNullSafe(F.col("name")))


# The kinds of TESTDATA.md and their bits.
KINDS = {"label": 0, "timestamp": TIMESTAMP, "sound": SOUND, "filler": FILLER, "head": HEAD, "no_speech": 6}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows = _segments(spark, d).select("seg_id", "surname", "differs", "text").mapInArrow(mask_batches, "seg_id bigint, mask int")
    kinds = F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(1 << b) != 0, k) for k, b in KINDS.items()]))
    return rows.select("seg_id", F.explode(kinds).alias("kind"))


def p4_turns(spark: SparkSession, d: str) -> DataFrame:
    """file_id, turn, speaker, start_us, end_us, n_segs, first_seg_id, spoken: the turns of each recording, numbered in order.

    A turn is the consecutive segments with speech (by start_us, end_us, seg_id) of one person; a silence of more
    than 600 s, which changes the session, ends it.  Segments without a file or a usable time belong to no turn."""
    rows = _segments(spark, d).filter("file_id is not null and start_us is not null and end_us >= start_us")
    rows = rows.select("surname", "text", "file_id", "start_us", "end_us", "seg_id", F.col("name").alias("speaker"))
    said = rows.mapInArrow(clean_batches, "file_id string, start_us bigint, end_us bigint, seg_id bigint, speaker string, spoken string")
    said = cut(said, "said")  # labelled once; the islands read it several times, most of them without the text
    order = ["start_us", "end_us", "seg_id"]
    breaks = (F.col("speaker") != F.col("prev_speaker")) | (F.col("start_us") - F.col("prev_end_us") > GAP_AT_MOST_US)
    marked = with_islands(said, "file_id", order, ["speaker", "end_us"], breaks, "turn")
    pieces = F.array_sort(F.collect_list(F.struct(*order, "spoken")))
    turns = marked.groupBy("file_id", "turn", "speaker").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count(F.lit(1)).alias("n_segs"), pieces.alias("pieces"))
    return turns.select("file_id", "turn", "speaker", "start_us", "end_us", "n_segs", F.col("pieces")[0]["seg_id"].alias("first_seg_id"), F.array_join(F.col("pieces.spoken"), " ").alias("spoken"))
