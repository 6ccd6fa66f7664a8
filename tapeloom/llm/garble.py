"""Problem 3: text decoded with a wrong character encoding, found and restored.

Round-trip repair.  Each run of text between mark-up is scored by a character
bigram model (its garbling cost).  A costly run is re-encoded under candidate
legacy encodings and strictly decoded as the intended encoding, again for
nested layers, and the result is accepted when the garbling cost drops.  Where
a run is garbled only in part, or some of its characters were lost, its words
are repaired one stretch at a time.  U+FFFD marks a character lost for good.

Defined results: null and empty html is no case and stays as it is; whole pages
are read, whatever their length.
"""

from __future__ import annotations

import codecs
import html as _html
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.spread import spread

# Encodings under which pages of these languages are read or written.
READ_AS = ("cp1251", "cp1252", "latin-1", "koi8-r", "cp866", "mac_cyrillic")
WRITTEN_IN = ("utf-8", "cp1251", "koi8-r", "cp866", "cp1252", "mac_cyrillic")
#: A word at least this costly (nats a character) makes its run a candidate.
WORD_COST = 4.4
#: A repair must save this much, in all and for each character that it changes.
SAVE_ALL, SAVE_EACH = 8.0, 0.7
#: Signs of two characters or more that read as UTF-8 need save only this much.
SAVE_SIGNS = 4.0
#: Readings by single-byte encodings that are followed at each layer; UTF-8 readings, which hardly come by chance, all are.
BEAM = 5
#: Runs and words up to this length whose repair a worker remembers; longer ones are worked out anew, to the same result.
SHORT, KEEP = 300, 100_000

_BORDER = re.compile(r"[<>]")
_ENTITY = re.compile(r"&(?!(?:lt|gt|amp|quot|apos);)#?\w+;")
_WORD = re.compile(r"\S+")
_MIXED = re.compile(r"[A-Za-zÀ-ɏ][Ѐ-ӿ]|[Ѐ-ӿ][A-Za-zÀ-ɏ]")
_PRIVATE = re.compile(r"[\ue000-\uf8ff]")
_SIGN = re.compile(r"[^\w\s\x00-\x7f]")
_CAPITAL = re.compile(r"(?<!\S)[^\w\s\x00-\x7f](?=[а-яё]{3})")
_SIGNS = re.compile(r"[^\x00-\x7fЀ-ӿ]{2,}")


def _table(encoding: str) -> str:
    """The 256 characters of a single-byte encoding; an undefined byte stands for its own control character."""
    return "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in range(256))


_ENCODE = {e: codecs.charmap_build(_table(e)) for e in READ_AS}
_DECODE = {e: _table(e) for e in WRITTEN_IN if e != "utf-8"}


def _decode(raw: bytes, encoding: str) -> str | None:
    try:
        return raw.decode("utf-8") if encoding == "utf-8" else codecs.charmap_decode(raw, "strict", _DECODE[encoding])[0]
    except UnicodeDecodeError:
        return None


class Costs:
    """Character bigram costs in nats, backed off to single characters; characters that right text lacks share class 0."""

    #: Cost of a character of class 0, and the weight of the single-character model.
    STRANGE, BACK_OFF = 14.0, 4.0

    def __init__(self, chars: str, counts: np.ndarray) -> None:
        self.of = np.zeros(0x10000, dtype=np.int32)
        for i, c in enumerate(chars):
            self.of[ord(c)] = i + 1
        n = counts.astype(float)
        n[0, :] = n[:, 0] = 0
        single = (n.sum(0) + 0.5) / (n.sum() + 0.5 * n.shape[1])
        self.nats = -np.log((n + self.BACK_OFF * single) / (n.sum(1, keepdims=True) + self.BACK_OFF)).astype(np.float32)
        self.nats[0, :] += 3.0
        self.nats[:, 0] = self.STRANGE

    def running(self, text: str) -> np.ndarray:
        """running[j] - running[i] is the cost of text[i:j]; the text stands between blanks."""
        code = np.frombuffer((" " + text).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        ids = self.of[np.where(code < 0x10000, code, 0)]
        out = np.zeros(len(text) + 1, dtype=np.float64)
        np.cumsum(self.nats[ids[:-1], ids[1:]], out=out[1:])
        return out

    def total(self, text: str) -> float:
        return float(self.running(text + " ")[-1])

    @staticmethod
    @lru_cache(1)
    def load() -> Costs:
        m = json.loads(resources.files("tapeloom.llm.models").joinpath("garble.json").read_text())
        n = len(m["chars"]) + 1
        counts = np.zeros((n, n))
        counts[m["rows"], m["cols"]] = m["counts"]
        return Costs(m["chars"], counts)


    def strange(self, text: str) -> int:
        return sum(1 for c in text if c > "\x7f" and (c > "\uffff" or not self.of[ord(c)]))


def _layers(text: str, single: bool) -> list[tuple[str, tuple[str, str]]]:
    """All readings of text one layer down; ``single``: by UTF-8 only, a single-byte layer was removed before."""
    out = []
    for read in READ_AS:
        try:
            raw = codecs.charmap_encode(text, "strict", _ENCODE[read])[0]
        except UnicodeEncodeError:
            continue
        for written in WRITTEN_IN:
            if single and written != "utf-8" or "mac_cyrillic" in (read, written) and not {read, written} <= {"mac_cyrillic", "cp1251", "utf-8"}:
                continue
            if written != read and (got := _decode(raw, written)) is not None and got != text:
                out.append((got, (read, written)))
    return out


def _choose(text: str, costs: Costs) -> list[tuple[str, str]]:
    return _short_choice(text, costs) if len(text) <= SHORT else _choice(text, costs)


def _choice(text: str, costs: Costs) -> list[tuple[str, str]]:
    """The layers whose removal gives text its least cost; none if nothing drops enough."""
    whole = costs.total(text)
    odd, strange = sum(c > "\x7f" for c in text) or 1, costs.strange(text)
    best, how = whole, []
    seen = {text}
    front = [(whole, text, [])]
    while front:  # a UTF-8 layer has fewer characters each time and a single-byte one comes once, so this ends
        ahead = []
        for _, t, steps in front:
            # words with one strange letter each, read by a single-byte encoding, are too little evidence, unless it stands among letters of another script
            told = max((len({c for c in w if c > "\x7f"}) for w in t.split()), default=0)
            for got, step in _layers(t, told < 2 and not _MIXED.search(t) or any(w != "utf-8" for _, w in steps)):
                if got not in seen:
                    seen.add(got)
                    ahead.append((costs.total(got), got, [*steps, step]))
        # a strict UTF-8 reading of non-ASCII text is hardly chance: it is followed even where the cost has not dropped yet
        ahead.sort(key=lambda x: (x[2][-1][1] != "utf-8", x[0]))
        sure = sum(x[2][-1][1] == "utf-8" for x in ahead)
        front = ahead[: sure + BEAM]
        for cost, got, steps in front:
            if cost < best - 2.0 and costs.strange(got) <= strange:
                best, how = cost, steps
    if not how:
        return []
    got = _apply(text, how) or ""
    # a sign in place of a word's capital is evidence of its own: what is saved by one letter is little
    capital = how == [("cp1251", "mac_cyrillic")] and all(got[m.start()].isupper() for m in _CAPITAL.finditer(text)) and len(_CAPITAL.findall(text)) == len(_SIGN.findall(text)) > 0
    if whole - best < (SAVE_SIGNS if capital else max(SAVE_ALL, SAVE_EACH * odd)):
        return []
    return [] if _PRIVATE.search(got) or len(_MIXED.findall(got)) > len(_MIXED.findall(text)) else how


_short_choice = lru_cache(KEEP)(_choice)


def _apply(text: str, steps: list[tuple[str, str]]) -> str | None:
    for read, written in steps:
        try:
            got = _decode(codecs.charmap_encode(text, "strict", _ENCODE[read])[0], written)
        except UnicodeEncodeError:
            return None
        if got is None:
            return None
        text = got
    return text


#: A restored run that costs less than this (nats a character) needs no search for a better reading.
GOOD_COST = 3.2


def _signs(text: str, a: int, b: int, costs: Costs) -> list[tuple[str, str]]:
    """The reading of signs that stand among right text, judged with what is around them; only UTF-8 is evidence enough."""
    near = lambda x: costs.total(text[max(0, a - 8) : a] + x + text[b : b + 8])
    whole, best, how = near(text[a:b]), 1e9, []
    for got, step in _layers(text[a:b], True):
        if (cost := near(got)) < best and costs.strange(got) <= costs.strange(text[a:b]):
            best, how = cost, [step]
    return how if whole - best >= SAVE_SIGNS else []


def repair_run(text: str, costs: Costs, known: list[list[tuple[str, str]]] | None = None) -> tuple[str, int]:
    """(text, layers): the run restored as far as it can be; 0 layers where it is right as it stands.

    known: readings that restored other runs of the page; they are tried first, and the list grows.
    """
    known = [] if known is None else known
    whole = costs.total(text)
    for steps in known:
        if (got := _apply(text, steps)) is not None and (cost := costs.total(got)) < GOOD_COST * (len(got) + 1) and whole - cost >= SAVE_ALL:
            return got, len(steps)
    got, layers, steps = _short_repair(text, costs) if len(text) <= SHORT else _alone(text, costs)
    if steps and steps not in known:
        known.append(steps)
    return got, layers


def _alone(text: str, costs: Costs) -> tuple[str, int, list[tuple[str, str]]]:
    """(text, layers, the reading of the whole): what repairs a run, whatever else its page holds."""
    if (steps := _choose(text, costs)) and (got := _apply(text, steps)) is not None:
        return got, len(steps), steps
    # in part: stretches of costly words
    run = costs.running(text + " ")
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    bad = [not text[a:b].isascii() and (run[b + 1] - run[a]) / (b - a + 1) >= WORD_COST for a, b in words]
    out, at, most, i = [], 0, 0, 0
    while i < len(words):
        if not bad[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(words) and bad[j + 1]:
            j += 1
        a, b = words[i][0], words[j][1]
        pieces = [(a, b)] if i == j else [(a, b), *words[i : j + 1]]
        signs = [m.span() for m in _SIGNS.finditer(text, a, b)]
        for a, b in [*pieces, *signs]:
            if a < at:
                continue
            steps = _signs(text, a, b, costs) if (a, b) in signs else _choose(text[a:b], costs)
            if steps and (got := _apply(text[a:b], steps)) is not None:
                out += [text[at:a], got]
                at, most = b, max(most, len(steps))
                if (a, b) == pieces[0]:
                    break
        i = j + 1
    return "".join([*out, text[at:]]), most, []


_short_repair = lru_cache(KEEP)(_alone)


def _words(text: str) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """((starts, ends) of the words outside mark-up signs, number of non-ASCII characters before each place)."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    odd = np.zeros(len(code) + 1, dtype=np.int64)
    np.cumsum(code > 127, out=odd[1:])
    inside = np.zeros(len(code) + 2, dtype=np.int8)
    inside[1:-1] = ~np.isin(code, (32, 9, 10, 13, 60, 62))
    step = np.diff(inside)
    return (np.flatnonzero(step == 1), np.flatnonzero(step == -1)), odd


def repair(page: str | None, costs: Costs) -> tuple[str | None, int, int]:
    """(html, runs repaired, characters lost).  Entities of characters are written as those characters."""
    if not page or page.isascii() and "&" not in page:
        return page, 0, 0
    text = _ENTITY.sub(lambda m: _html.unescape(m.group()), page) if "&" in page else page
    lost = text.count("�")
    if text.isascii():
        return page, 0, lost
    run = costs.running(text)
    bounds, odd = _words(text)
    x, y = bounds
    costly = np.flatnonzero(((run[np.minimum(y + 1, len(text))] - run[x]) / (y - x + 1) >= WORD_COST) & (odd[y] > odd[x]))
    known: list[list[tuple[str, str]]] = []
    runs, done = [], 0
    for k in costly:
        if x[k] < done:
            continue
        a = max(text.rfind("<", 0, x[k]), text.rfind(">", 0, x[k])) + 1
        end = _BORDER.search(text, y[k])
        b = done = end.start() if end else len(text)
        runs.append((a, b))
    got = [repair_run(text[a:b], costs, known) for a, b in runs]
    if known:  # what a later run taught may restore an earlier one
        got = [g if g[1] else repair_run(text[a:b], costs, known) for g, (a, b) in zip(got, runs, strict=True)]
    out, at, n = [], 0, 0
    for (a, b), (new, layers) in zip(runs, got, strict=True):
        if layers:
            out += [text[at:a], new]
            at, n = b, n + 1
    return ("".join([*out, text[at:]]) if n else page), n, lost


def _repair_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    costs = Costs.load()
    for b in batches:
        got = [repair(x, costs) for x in b["html"]]
        yield pd.DataFrame({"page_id": b["page_id"], "html": [g[0] for g in got], "n_repaired": [g[1] for g in got], "n_lost": [g[2] for g in got]})


def repair_pages(pages: DataFrame) -> DataFrame:
    """page_id, html, n_repaired, n_lost for every page; other columns are not carried."""
    return spread(pages.select("page_id", "html")).mapInPandas(_repair_batches, "page_id bigint, html string, n_repaired int, n_lost int")


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The garbled pages with their html restored as far as it can be."""
    return repair_pages(spark.read.parquet(f"{d}/rkka.parquet")).filter("n_repaired > 0 or n_lost > 0")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_repaired(spark, d).filter(F.col("page_id").isNotNull()).select("page_id").distinct()
