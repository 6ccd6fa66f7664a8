"""Problem 6: the whole corpus encoded by a public byte-level BPE tokenizer.

The merges are compiled into a lazily determinised finite-state transducer.
It rests on two facts of BPE: a sequence of tokens is the encoding of its bytes
exactly if every two neighbours are (``_pair``), and so the encoding of a text
is fixed by the last token of the encoding of each of its prefixes.  A state is
the last token that was emitted and the bytes not yet decided; reading a byte
leads to the next state and emits the tokens that no later byte can change.
Lookahead is bounded: bytes stay undecided only while a token can still begin
among them.  States and their transitions are made when first met and kept.

Decoding is streamed: an incremental UTF-8 state machine takes the bytes of one
token at a time and gives out the characters that are complete.

Defined results: null and empty text give the empty list; special-token strings
in a text are ordinary text; whole texts are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.spread import spread

#: Folder of the vocabulary files; None: the installed public_tokenizers.
TOKENIZERS: str | None = None
#: States and finished pieces that a worker keeps; beyond, it starts anew.
KEEP_STATES, KEEP_PIECES = 200_000, 200_000


def vocabulary_path(file: str, folder: str | None = None) -> str:
    if folder or TOKENIZERS:
        return f"{folder or TOKENIZERS}/{file}"
    import public_tokenizers

    return public_tokenizers.path(file)


class Transducer:
    """Encoder of one byte-level BPE vocabulary given as ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.prefixes = {b[:n] for b in ranks for n in range(1, len(b) + 1)}
        self.longest = max(map(len, ranks))
        self.find = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.moves: dict[tuple[int, bytes], tuple[tuple[int, ...], int, bytes]] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}

    def _merge(self, raw: bytes) -> list[int]:
        """BPE of a short byte string by its definition: the lowest-ranked pair first."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _pair(self, left: int, right: int) -> bool:
        """Whether left and right may be neighbours; -1 is the beginning of a piece."""
        if left < 0:
            return True
        if (known := self.pairs.get((left, right))) is None:
            known = self.pairs[left, right] = self._merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    @lru_cache(200_000)  # noqa: B019 - one transducer lives as long as its worker
    def _alone(self, token: int) -> bool:
        return self._merge(self.bytes_of[token]) == [token]

    def _tokens(self, last: int, raw: bytes) -> list[list[int]]:
        """For each prefix of raw, its encoding after ``last`` (whose end is decided)."""
        paths: list[list[int] | None] = [[]]
        for end in range(1, len(raw) + 1):
            got = None
            for start in range(max(0, end - self.longest), end):
                token = self.ranks.get(raw[start:end])
                before = paths[start]
                if token is not None and before is not None and self._alone(token) and self._pair(before[-1] if before else last, token):
                    got = [*before, token]
                    break
            paths.append(got)
        return paths

    def _move(self, last: int, raw: bytes) -> tuple[tuple[int, ...], int, bytes]:
        """The decided tokens of raw after ``last``, and the state that is left."""
        paths = self._tokens(last, raw)
        whole = paths[-1]
        open_at = [s for s in range(max(0, len(raw) - self.longest), len(raw)) if raw[s:] in self.prefixes and paths[s] is not None]
        ways = [paths[s] for s in open_at] + ([whole] if whole is not None else [])
        shared = min(map(len, ways))
        first = ways[0]
        while shared and any(w[:shared] != first[:shared] for w in ways):
            shared -= 1
        done = tuple(first[:shared])
        rest = raw[sum(len(self.bytes_of[t]) for t in done) :]
        return done, (done[-1] if done else last), rest

    def piece(self, raw: bytes) -> tuple[int, ...]:
        out: list[int] = []
        last, rest, moves = -1, b"", self.moves
        for i in range(len(raw)):
            key = (last, rest + raw[i : i + 1])
            move = moves.get(key)
            if move is None:
                if len(moves) >= KEEP_STATES:
                    moves.clear()
                move = moves[key] = self._move(*key)
            done, last, rest = move
            if done:
                out += done
        if rest:
            out += self._tokens(last, rest)[-1]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        pieces = self.pieces
        for p in self.find(text):
            ids = pieces.get(p)
            if ids is None:
                ids = self.piece(p.encode())
                if len(p) <= 64:
                    if len(pieces) >= KEEP_PIECES:
                        pieces.clear()
                    pieces[p] = ids
            out += ids
        return out


@lru_cache(4)
def transducer(name: str, folder: str | None = None) -> Transducer:
    import public_tokenizers

    with open(vocabulary_path(f"{name}.tiktoken", folder), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Transducer(ranks, public_tokenizers.PATTERN)


class Utf8Stream:
    """Incremental UTF-8: bytes in, complete characters out; a byte that fits nowhere gives U+FFFD."""

    def __init__(self) -> None:
        self.need, self.value, self.least = 0, 0, 0

    def feed(self, raw: bytes) -> str:
        out = []
        for b in raw:
            if self.need and b & 0xC0 == 0x80:
                self.value, self.need = self.value << 6 | b & 0x3F, self.need - 1
                if not self.need:
                    good = self.value >= self.least and self.value <= 0x10FFFF and not 0xD800 <= self.value <= 0xDFFF
                    out.append(chr(self.value) if good else "�")
                continue
            if self.need:
                out.append("�")
                self.need = 0
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b < 0xF5:
                self.need, self.value, self.least = (1, b & 0x1F, 0x80) if b < 0xE0 else (2, b & 0x0F, 0x800) if b < 0xF0 else (3, b & 0x07, 0x10000)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        left, self.need = self.need, 0
        return "�" if left else ""


def decode(ids: Iterable[int], t: Transducer) -> str:
    stream = Utf8Stream()
    return "".join([stream.feed(t.bytes_of[i]) for i in ids]) + stream.end()


def encode_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """doc_id, ids of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(tokenizer, folder)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = [t.encode(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return spread(docs.select("doc_id", "text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """doc_id, text of (doc_id, ids): the streamed decoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(tokenizer, folder)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(x or (), t) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{d}/documents.parquet"))


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, n_ids, same: whether the decoded ids are the text again (null as empty)."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    encoded = encode_documents(docs)
    back = decode_documents(encoded).withColumnRenamed("text", "back")
    sizes = encoded.select("doc_id", F.size("ids").alias("n_ids"))
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(back, "doc_id").join(sizes, "doc_id")
    return joined.select("doc_id", "n_ids", (F.col("text") == F.col("back")).alias("same"))
