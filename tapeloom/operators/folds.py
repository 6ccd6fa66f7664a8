"""Ordered state machines over transcripts.

A fold runs in Python over groups that the rules themselves keep apart (runs of
one speaker, stretches without a break), never over a whole recording.  Groups
are streamed through ``fold``: one shuffle by group, a sort inside partitions,
and no call per group from the JVM.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import matching as M
from tapeloom.operators.intervals import periods
from tapeloom.operators.ordered import interval_join, with_greatest_before, with_islands, with_neighbours, with_running_sum
from tapeloom.session import cut

ORDER = ["start_us", "seg_id"]
JOURNALIST, OPERATOR = "Журналист", "Оператор"


def fold(df: DataFrame, keys: list[str], order: list[str], step: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """``step`` on the ordered rows of every group; a group may span Arrow batches."""
    names = [c.split()[0] for c in _columns(schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows = None, []
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                k = tuple(r[c] for c in keys)
                if k != at:
                    if rows:
                        out += step(rows)
                    at, rows = k, []
                rows.append(r)
            yield pd.DataFrame(out, columns=names)
        if rows:
            yield pd.DataFrame(step(rows), columns=names)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def _columns(schema: str) -> list[str]:
    out, depth, at = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(at.strip())
            at = ""
        else:
            at += c
    return [*out, at.strip()]


# WN8 --------------------------------------------------------------------------------------------------------------

REPLICA = "file_id string, seg_id bigint, start_us bigint, end_us bigint, speaker string, raw_speaker_id string, text string, n int, sub_segments array<struct<start_us bigint, end_us bigint, words int>>"


def _joins(group: dict, r: dict, texts: list[str], pause: float) -> str:
    """What a row does to a group of one speaker: "same" (says the last text again), "next" or "stop"."""
    if pause < 0:
        like = M.ratio(texts[-1], r["text"] or "")
        return "same" if like > 0.85 else "next" if like > 0.60 or -pause <= 2.0 else "stop"
    if group["speaker"] == JOURNALIST:
        return "next" if pause <= 3.0 else "stop"
    return "next" if pause <= 2.0 or pause <= 5.0 and any(M.similarity(r["text"], t) > 0.75 for t in texts[-2:]) else "stop"


def merge_run(rows: list[dict]) -> list[dict]:
    """The replica merge on rows of one speaker in a row: guards, pauses and likeness decide what joins.

    A row that says the last text again takes its place if it is longer and is absorbed if not; either way it counts as no member more."""
    out, i = [], 0
    while i < len(rows):
        first = rows[i]
        apart = first["speaker"] in (JOURNALIST, OPERATOR)
        texts, members, end, gap_end = [first["text"] or ""], [first], first["end_us"], None
        for j in range(i + 1, len(rows) + 1):
            if j == len(rows):
                break
            r = rows[j]
            text, pause = r["text"] or "", (r["start_us"] - end) / 1e6
            if apart and first["raw_speaker_id"] and r["raw_speaker_id"] and first["raw_speaker_id"] != r["raw_speaker_id"]:
                break
            lost = r["end_us"] < r["start_us"] or gap_end is not None and r["start_us"] < gap_end
            if not lost and r["from_gap"]:
                gap_end = r["end_us"]
                lost = M.corrupted(text, texts)
            if lost:
                end = max(end, r["end_us"])
                continue
            does = _joins(first, r, texts, pause)
            if does == "stop":
                break
            if does == "next":
                texts.append(text)
                members.append(r)
            elif len(text) > len(texts[-1]):
                texts[-1], members[-1] = text, r
            end = r["end_us"]
        said = M.cleaned(M.without_loops(M.joined(texts)))
        if said:
            longest = max(members, key=lambda r: len(r["text"] or ""))
            out.append({"file_id": first["file_id"], "seg_id": first["seg_id"], "start_us": first["start_us"], "end_us": end, "speaker": longest["speaker"], "raw_speaker_id": longest["raw_speaker_id"], "tape_no": first.get("tape_no"), "text": said, "n": len(members), "sub_segments": [{"start_us": r["start_us"], "end_us": r["end_us"], "words": len((r["text"] or "").split())} for r in members]})
        i = j
    return out


def merge_replicas(segments: DataFrame, schema: str = REPLICA) -> DataFrame:
    """WN8 on (file_id, seg_id, start_us, end_us, speaker, raw_speaker_id, text, from_gap).

    A change of speaker ends a replica, and so does a start more than 5 s after all ends before it, whatever the rules have kept; groups part at both, so speech without such pauses bounds a group."""
    rows = with_greatest_before(segments, "file_id", ORDER, F.col("end_us"), "_reach")
    ends = (F.col("prev_speaker") != F.col("speaker")) | (F.col("start_us") - F.col("_reach") > 5_000_000)
    runs = with_islands(rows, "file_id", ORDER, ["speaker"], F.coalesce(ends, F.lit(True)), "run", using=["_reach"]).drop("_reach")
    return fold(runs, ["file_id", "run"], ORDER, merge_run, schema)


# WN9, CL1, JN3 ----------------------------------------------------------------------------------------------------


def carry_run(rows: list[dict]) -> list[dict]:
    """A short last sentence goes over to the next speaker's replica, unless it speaks against that: the interviewer's words to another, the expert's to the interviewer."""
    texts = [r["text"] or "" for r in rows]
    for i, (a, b) in enumerate(zip(rows, rows[1:], strict=False)):
        parts = re.split(r"[.!?]+\s+", texts[i])
        last, asks_next = parts[-1].strip(), b["speaker"] == JOURNALIST
        if a["speaker"] == b["speaker"] or b["start_us"] - a["end_us"] > 500_000 or len(parts) < 2 or len(last.split()) > 10:
            continue
        if M.journalist_says(last) and not asks_next or M.expert_says(last, a["surname"]) and asks_next:
            continue
        if rest := ". ".join(parts[:-1]).strip():
            texts[i] = rest + "."
        texts[i + 1] = f"{last} {texts[i + 1]}".strip()
    return [{**r, "text": t} for r, t in zip(rows, texts, strict=True)]


def boundary_carry(segments: DataFrame, schema: str = "seg_id bigint, text string") -> DataFrame:
    """WN9 on (file_id, seg_id, start_us, end_us, speaker, surname, text): sentences move only over pauses of at most half a second, so longer ones part the groups.

    ``schema`` names the columns that come out."""
    near = with_islands(segments, "file_id", ORDER, ["end_us"], F.coalesce(F.col("start_us") - F.col("prev_end_us") > 500_000, F.lit(True)), "near")
    return fold(near, ["file_id", "near"], ORDER, carry_run, schema)


def classify_run(rows: list[dict]) -> list[dict]:
    """A continuation after a run of more than 30 s stays with its speaker, as corrected so far; else scores flip."""
    out, who, since = [], None, 0
    for r in rows:
        speaker = r["speaker"]
        if r["nw"] >= 5 and speaker != OPERATOR:
            if r["continues"] and who is not None and r["prev_end"] - since > 30_000_000:
                speaker = who
            elif speaker == r["surname"] and r["j"] - r["s"] > 3:
                speaker = JOURNALIST
            elif speaker == JOURNALIST and r["s"] - r["j"] > 3:
                speaker = r["surname"]
        if speaker != who:
            who, since = speaker, r["start_us"]
        out.append({**r, "speaker": speaker})
    return out


def context_run(rows: list[dict]) -> list[dict]:
    """WN3: a very short row before a long one of another is the beginning of that; a short one between two of one speaker is theirs.  The row before counts as corrected."""
    out, before = [], None
    for r in rows:
        who, raw, long = r["speaker"], r["raw_speaker_id"], r["end_us"] - r["start_us"]
        after = r["next_speaker"]
        if not r["edge"]:
            prev = before or (r["prev_speaker"], r["prev_raw_speaker_id"])
            if long < 1_000_000 and r["nw"] < 5 and r["next_long"] > 5_000_000 and after and who != after:
                who, raw = after, r["next_raw_speaker_id"]
            elif long < 3_000_000 and after and prev[0] == after and who != after:
                who, raw = prev
        before = (who, raw)
        out.append({"seg_id": r["seg_id"], "speaker": who, "raw_speaker_id": raw})
    return out


def corrected_by_context(segments: DataFrame) -> DataFrame:
    """WN3 on (file_id, seg_id, start_us, end_us, speaker, raw_speaker_id, nw): a row of 3 s or more never changes, so what it begins is a group of its own."""
    r = with_neighbours(segments, "file_id", ORDER, ["start_us", "end_us", "speaker", "raw_speaker_id"])
    r = r.withColumns({"edge": F.col("prev_end_us").isNull() | F.col("next_end_us").isNull(), "next_long": F.coalesce(F.col("next_end_us") - F.col("next_start_us"), F.lit(0)), "_fixed": F.when(F.col("end_us") - F.col("start_us") >= 3_000_000, 1).otherwise(0)})
    r = with_running_sum(r, "file_id", ORDER, F.col("_fixed"), "near").drop("_fixed", "prev_start_us", "prev_end_us", "next_start_us", "next_end_us")
    return fold(r, ["file_id", "near"], ORDER, context_run, "seg_id bigint, speaker string, raw_speaker_id string")


def map_run(rows: list[dict]) -> list[dict]:
    """JN3: the same label after less than 2 s keeps the speaker; short patterns are the journalist's; else the role."""
    out, before, label, end = [], None, None, None
    for r in rows:
        if r["role"] == OPERATOR:
            who = OPERATOR
        elif label is not None and r["raw_speaker_id"] == label and (r["start_us"] - end) < 2_000_000:
            who = before
        elif r["asks"] and r["end_us"] - r["start_us"] < 20_000_000:
            who = JOURNALIST
        else:
            who = r["role"] or r["surname"]
        out.append({"seg_id": r["seg_id"], "speaker": who})
        before, label, end = who, r["raw_speaker_id"], r["end_us"]
    return out


def map_speakers(rows: DataFrame) -> DataFrame:
    """JN3 on (file_id, tape_no, seg_id, start_us, end_us, raw_speaker_id, role, surname, asks): a pause of 2 s, another label or another tape ends the memory."""
    same_tape = F.col("prev_tape_no").eqNullSafe(F.col("tape_no"))
    cut_at = F.coalesce((F.col("start_us") - F.col("prev_end_us") >= 2_000_000) | (F.col("prev_raw_speaker_id") != F.col("raw_speaker_id")) | ~same_tape, F.lit(True))
    r = with_islands(rows, "file_id", ORDER, ["end_us", "raw_speaker_id", "tape_no"], cut_at, "near")
    return fold(r, ["file_id", "near"], ORDER, map_run, "seg_id bigint, speaker string")


# DD1, DD2 ---------------------------------------------------------------------------------------------------------

PAIR = "file_id string, ra bigint, rb bigint, seg_a bigint, seg_b bigint, same boolean, a_start bigint, b_start bigint, a_len int, b_len int"


def alike_pairs(segments: DataFrame, across: bool, reach: int) -> DataFrame:
    """Pairs at most ``reach`` rows apart with nearly equal texts, of two speakers (``across``) or of one.

    Lengths that rule a likeness out are dropped in the JVM, letter counts in Python before the matcher runs.
    """
    r = with_running_sum(segments.filter("text is not null and trim(text) <> ''"), "file_id", ORDER, F.lit(1), "rn")
    side = lambda s, n: [F.col(c).alias(f"{n}_{c}") for c in s]
    keep = ["seg_id", "speaker", "text", "start_us", "end_us", "rn"]
    a = r.select("file_id", *side(keep, "a"), F.explode(F.array(F.expr(f"rn div {reach}"), F.expr(f"rn div {reach} + 1"))).alias("bin"))
    b = r.select("file_id", *side(keep, "b"), F.expr(f"rn div {reach}").alias("bin"))
    floor = 0.85 if across else 0.70
    p = a.join(b, ["file_id", "bin"]).filter(f"b_rn between a_rn + 1 and a_rn + {reach}")
    p = p.filter("a_speaker <> b_speaker and abs(b_start_us - a_start_us) < 5000000" if across else "a_speaker = b_speaker")
    p = p.filter(f"2.0 * least(length(a_text), length(b_text)) / (length(a_text) + length(b_text)) > {floor}")
    over = F.greatest(F.lit(0), F.least("a_end_us", "b_end_us") - F.greatest("a_start_us", "b_start_us")) / F.col("a_dur")
    p = p.withColumn("a_dur", F.col("a_end_us") - F.col("a_start_us")).withColumn("ov", F.when(F.col("a_dur") > 0, over).otherwise(0.0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[str, str, float], bool] = {}
        for x in batches:
            keep_it = []
            for s, t, ov in zip(x["a_text"].str.lower().str.strip(), x["b_text"].str.lower().str.strip(), x["ov"], strict=True):
                need = 0.70 if not across and ov > 0.95 else 0.85
                alike = s == t or known.get((s, t, need))
                if alike is None:
                    if len(known) > 100_000:
                        known.clear()
                    alike = known[s, t, need] = M.likely(s, t, need) and M.ratio(s, t) > need
                keep_it.append(alike)
            x = x[keep_it]
            yield pd.DataFrame({"file_id": x["file_id"], "ra": x["a_rn"], "rb": x["b_rn"], "seg_a": x["a_seg_id"], "seg_b": x["b_seg_id"], "same": x["a_speaker"] == x["b_speaker"], "a_start": x["a_start_us"], "b_start": x["b_start_us"], "a_len": x["a_text"].str.len().astype("int32"), "b_len": x["b_text"].str.len().astype("int32")})

    return p.select("file_id", "a_rn", "b_rn", "a_seg_id", "b_seg_id", "a_speaker", "b_speaker", "a_start_us", "b_start_us", "a_text", "b_text", "ov").mapInPandas(run, PAIR)


def greedy(rows: list[dict]) -> list[dict]:
    """DD1: pairs in the order of their rows; a row that is gone removes no other; the one that others hide goes, else the later."""
    gone: set[int] = set()
    out = []
    for r in rows:
        if r["seg_a"] in gone or r["seg_b"] in gone:
            continue
        lose_a = r["a_hidden"] if r["a_hidden"] != r["b_hidden"] else r["a_start"] > r["b_start"]
        lost, kept = ("seg_a", "seg_b") if lose_a else ("seg_b", "seg_a")
        gone.add(r[lost])
        out.append({"file_id": r["file_id"], "removed": r[lost], "kept": r[kept]})
    return out


def stars(rows: list[dict]) -> list[dict]:
    """DD2: pairs in the order of their rows; a row that no earlier one took takes all its duplicates that are free; of such a group the longest text stays, the first of equals."""
    taken: set[int] = set()
    groups: dict[int, list[tuple[int, int]]] = {}
    for r in rows:
        if r["seg_a"] not in taken and r["seg_b"] not in taken:
            groups.setdefault(r["seg_a"], [(r["a_len"], r["seg_a"])]).append((r["b_len"], r["seg_b"]))
            taken.add(r["seg_b"])
    out = []
    for group in groups.values():
        kept = max(group, key=lambda x: x[0])[1]
        out += [{"file_id": rows[0]["file_id"], "removed": x, "kept": kept} for _, x in group if x != kept]
    return out


def with_hidden(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds a_hidden and b_hidden: whether all other segments than the pair's two cover more than half of each; a segment of no length is hidden."""
    ids = pairs.select(F.explode(F.array("seg_a", "seg_b")).alias("seg_id")).distinct()
    times = segments.select("file_id", "seg_id", "start_us", "end_us")
    left = times.join(ids, "seg_id", "left_semi").select("file_id", "seg_id", F.col("start_us").alias("l_start"), F.col("end_us").alias("l_end"))
    right = times.filter("end_us > start_us").select("file_id", F.col("seg_id").alias("other"), F.col("start_us").alias("r_start"), F.col("end_us").alias("r_end"))
    ov = interval_join(left.filter("l_end > l_start"), right, "file_id").filter("seg_id <> other").groupBy("seg_id").agg(F.sum(F.least("l_end", "r_end") - F.greatest("l_start", "r_start")).alias("by_all"))
    all_ = left.join(ov, "seg_id", "left").select("seg_id", "l_start", "l_end", F.coalesce("by_all", F.lit(0)).alias("by_all"))
    for x in "ab":
        pairs = pairs.join(all_.select(F.col("seg_id").alias(f"seg_{x}"), *[F.col(c).alias(f"{x}_{c}") for c in ("l_start", "l_end", "by_all")]), f"seg_{x}")
    shared = F.greatest(F.lit(0), F.least("a_l_end", "b_l_end") - F.greatest("a_l_start", "b_l_start"))
    for x in "ab":
        length = F.col(f"{x}_l_end") - F.col(f"{x}_l_start")
        pairs = pairs.withColumn(f"{x}_hidden", (length <= 0) | (2 * (F.col(f"{x}_by_all") - shared) > length))
    return pairs.drop(*[f"{x}_{c}" for x in "ab" for c in ("l_start", "l_end", "by_all")])


def near_duplicates(segments: DataFrame, across: bool) -> DataFrame:
    """(file_id, removed, kept): DD1 (across speakers, nine rows) or DD2 (one speaker, ten rows), resolved cluster by cluster."""
    p = alike_pairs(segments, across, 9 if across else 10)
    p = cut(p, "alike")  # the matcher runs once; pairs are read for the clusters and for their rows
    if across:
        p = with_hidden(p, segments)
    clusters = periods(p, ["file_id"], "ra", "rb", chunk_us=100_000).select("file_id", F.col("ra").alias("c_from"), F.col("rb").alias("c_to"))
    c = clusters.withColumn("bin", F.explode(F.sequence(F.expr("c_from div 1000"), F.expr("c_to div 1000"))))
    p = p.withColumn("bin", F.expr("ra div 1000")).join(c, ["file_id", "bin"]).filter("ra between c_from and c_to")
    return fold(p, ["file_id", "c_from"], ["ra", "rb"], greedy if across else stars, "file_id string, removed bigint, kept bigint")


# JN10 -------------------------------------------------------------------------------------------------------------


def align_section(rows: list[dict]) -> list[dict]:
    """Two sorted lists of whole seconds: equal ones meet, else the first unused within 5 s that has no equal; what is left stands alone."""
    de, ru = sorted({r["sec"] for r in rows if r["side"] == 0}), sorted({r["sec"] for r in rows if r["side"] == 1})
    equal, used = set(de) & set(ru), set()
    out, part = [], rows[0]["part"]
    for s in de:
        near = range(bisect_left(ru, s - 5), bisect_right(ru, s + 5))
        hit = s if s in equal else next((ru[k] for k in near if ru[k] not in used and ru[k] not in equal), None)
        used.add(hit)
        out.append({"part": part, "de_sec": s, "ru_sec": hit})
    return out + [{"part": part, "de_sec": None, "ru_sec": x} for x in ru if x not in used]


# JN8 --------------------------------------------------------------------------------------------------------------


def fill_run(rows: list[dict]) -> list[dict]:
    """Filled gaps in order: clamped to the gap before and the row after, too short ones dropped, texts trimmed at both seams, restarts of the next text dropped.

    Who speaks: the neighbours decide, then the role that most of the time overlaps for more than a second, then the interviewer's words, then a next text that is nearly the same."""
    out, last = [], None
    for r in rows:
        start, end, text = r["start_us"], r["end_us"], (r["text"] or "").strip()
        following = None if r["next_start"] is None or r["next_start"] != r["next_start"] else int(r["next_start"])
        if len(set(text.lower())) < 3:
            continue
        if last is not None and start < last + 500_000:
            start = last
        if following is not None and end > following - 500_000:
            end = following
        if end - start < 1_000_000:
            continue
        text = M.trim_after(M.trim_before(text, r["next_text"] or "", 7), r["prev_text"] or "")
        if not text.strip() or M.restarts(text, r["next_text"] or ""):
            continue
        who = JOURNALIST if M.journalist_says(text) else r["dominant"] or r["decided"]
        if r["next_text"] and r["next_speaker"] and M.similarity(text, r["next_text"]) > 0.70:
            who = r["next_speaker"]
        last = end
        out.append({"seg_id": r["seg_id"], "start_us": start, "end_us": end, "speaker": who, "text": text})
    return out
