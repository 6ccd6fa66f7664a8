"""Problem 7: texts, measured in tokens, put whole into containers of fixed capacity.

Linear grouping.  Large lengths are rounded up within groups of equal
cardinality, so that few sizes are left; a linear programme over all
configurations (multisets of those sizes that fit a container) finds how often
each is used with the fewest containers in all, its columns generated by a
knapsack; the whole parts of that solution are used, the actual documents take
the slots of their group; what the rounding leaves and the small ones are then
put, longest first, where they fit best.  Best fit alone is planned beside it on
the same counts, and the plan with fewer containers holds, so grouping never
costs a container.  A text beyond the capacity is cut into parts of the capacity
and one rest.

The plan needs nothing but the number of items of each length: one partial
aggregate, at most as many counts for a kind of container as there are lengths
up to its capacity, whatever the corpus.  The plan is a list of ranges (length,
ranks) -> containers.  Items get their rank within their length in as many
buckets as their number asks for, and find their range by an equi join on blocks
of ranks.

Defined results: a null, empty or otherwise token-less text needs no room and
gets no row; ties are ranked by (doc_id, part); equal rows are ranked one after
the other.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tapeloom.llm.bpe import transducer, vocabulary_path
from tapeloom.llm.spread import spread
from tapeloom.session import cut

#: Groups of large lengths, the least share of the capacity that is large, and the steps of the capacity that configurations are told apart by.
GROUPS, LARGE, STEPS = 64, 1 / 6, 16_384
#: Items of one length in a bucket in which they are ranked, about; ranks in a block by which items and ranges are joined.
BUCKET_ROWS, BLOCK = 500_000, 4096


@lru_cache(2)
def _sentencepiece(name: str, folder: str | None):  # noqa: ANN202
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(f"{name}.model", folder))


def count_tokens(name: str, texts: list[str], folder: str | None = None) -> list[int]:
    if name.startswith("byte_bpe"):
        t = transducer(name, folder)
        return [len(t.encode(x)) for x in texts]
    if name.startswith("piece"):
        return [len(x) for x in _sentencepiece(name, folder).encode(texts, num_threads=1)]
    if name.startswith("word_bpe"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(vocabulary_path(f"{name}.json", folder))
        t.encode_special_tokens = True
        return [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]
    raise ValueError(f"unknown tokenizer {name}")


def lengths(docs: DataFrame, tokenizers: list[str], folder: str | None = None) -> DataFrame:
    """doc_id and one int column for each tokenizer; null and empty texts have 0 tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [x or "" for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(count_tokens(t, texts, folder), pa.int32()) for t in tokenizers]], ["doc_id", *tokenizers])

    return spread(docs.select("doc_id", "text")).mapInArrow(run, "doc_id bigint" + "".join(f", `{t}` int" for t in tokenizers))


def _dearest(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes of the greatest price that fits, and its price: an unbounded knapsack over all rooms at once."""
    best = np.zeros(capacity + 1)
    stages = []
    for size, price in zip(sizes.tolist(), prices.tolist(), strict=True):
        stages.append(best)
        if price <= 0:
            continue
        for _ in range(capacity // size):
            more = best.copy()
            np.maximum(more[size:], best[: capacity + 1 - size] + price, out=more[size:])
            if np.array_equal(more, best):
                break
            best = more
    take, room, worth = np.zeros(len(sizes), np.int64), capacity, best[capacity]
    for i in range(len(sizes) - 1, -1, -1):
        after = stages[i + 1] if i + 1 < len(sizes) else best
        worth = after[room]
        while worth > stages[i][room] + 1e-12:
            take[i] += 1
            room -= int(sizes[i])
            worth -= prices[i]
    return float(best[capacity]), take


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """The linear programme: configurations and how often each is used, so that all demand is met with the fewest containers.

    A revised simplex; the configuration that enters is the dearest knapsack at the prices of the basis."""
    k = len(sizes)
    step = -(-capacity // STEPS)
    size = -(-np.array(sizes, np.int64) // step)  # rounded up: what fits in steps fits in tokens
    room = capacity // step
    fits = size <= room
    size = np.where(fits, size, room)  # a size that only rounding to steps makes too large fills a container
    basis, cost = np.diag((room // size).astype(float)), np.ones(k)
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ np.array(demand, float)
    for _ in range(60 * k + 200):
        prices = cost @ inverse
        least = int(prices.argmin())
        if prices[least] < -1e-9:  # more than the demand of this size is cheaper: its surplus enters
            column, price = -np.eye(k)[least], 0.0
        else:
            worth, take = _dearest(size, prices, room)
            if worth <= 1 + 1e-7:
                break
            column, price = take.astype(float), 1.0
        along = inverse @ column
        ratio = np.where(along > 1e-9, use / np.where(along > 1e-9, along, 1.0), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        use = use - ratio[out] * along
        use[out] = ratio[out]
        pivot = inverse[out] / along[out]
        inverse = inverse - np.outer(along, pivot)
        inverse[out] = pivot
        basis[:, out], cost[out] = column, price
    return [(basis[:, j].round().astype(int).tolist(), float(use[j])) for j in range(k) if cost[j] and use[j] > 1e-9]


class Plan:
    """Ranges (length, rank_from, rank_to, first_bin, per_bin, n_bins) and the free room of the containers so far."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.left, self.rank = capacity, dict(counts), dict.fromkeys(counts, 0)
        self.ranges: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: dict[int, list[list[int]]] = defaultdict(list)  # free room -> [first_bin, n_bins]
        self.bins = 0

    def put(self, length: int, first: int, per: int, n: int) -> None:
        """The next per * n items of a length, per in each of n containers."""
        self.ranges.append((length, self.rank[length], self.rank[length] + per * n, first, per, n))
        self.rank[length] += per * n
        self.left[length] -= per * n

    def fill(self, groups: list[list[int]], take: list[int], times: int) -> None:
        """``times`` containers of one configuration: each slot takes the longest items of its group that are left."""
        slots = [i for i, n in enumerate(take) for _ in range(n)]
        while times:
            # a run of containers that all take the same lengths
            now, need = [], defaultdict(int)
            for i in slots:
                length = next((x for x in groups[i] if self.left[x] > need.get(x, 0)), None)
                if length is not None:
                    now.append(length)
                    need[length] += 1
            if not now:
                return
            run = min([times, *(max(1, self.left[x] // n) for x, n in need.items())])
            for length, n in need.items():
                self.put(length, self.bins, n, run)
            self._free(self.capacity - sum(now), self.bins, run)
            self.bins += run
            times -= run

    def _free(self, room: int, first: int, n: int) -> None:
        if room > 0 and n:
            self.gaps[room].append([first, n])

    def best_fit(self) -> None:
        """All items left, longest first, each where the least room is left over."""
        free = sorted(g for g in self.gaps if self.gaps[g])
        for s in sorted((s for s, n in self.left.items() if n), reverse=True):
            while n := self.left[s]:
                k = bisect.bisect_left(free, s)
                if k == len(free):  # new containers of this length alone, as many in each as fit
                    per = min(n, self.capacity // s)
                    use, first, gap = n // per, self.bins, self.capacity
                    self.bins += use
                else:
                    gap = free[k]
                    first, have = self.gaps[gap][-1]
                    per = min(gap // s, n)
                    use = min(have, n // per)
                    if use == have:
                        self.gaps[gap].pop()
                        if not self.gaps[gap]:
                            free.pop(k)
                    else:
                        self.gaps[gap][-1] = [first + use, have - use]
                self.put(s, first, per, use)
                rest = gap - per * s
                if rest:
                    if not self.gaps[rest]:
                        bisect.insort(free, rest)
                    self.gaps[rest].append([first, use])


def grouped(counts: dict[int, int], groups: int) -> list[list[int]]:
    """Lengths, longest first, in groups of about equal cardinality; a group's first is what it is rounded up to."""
    total, out, room = sum(counts.values()), [], 0
    each = max(1, -(-total // groups))
    for s in sorted(counts, reverse=True):
        if room <= 0:
            out.append([])
            room = each
        out[-1].append(s)
        room -= counts[s]
    return out


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS, large: float = LARGE) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges (length, rank_from, rank_to, first_bin, per_bin, n_bins): the items of a length with those ranks
    fill n_bins containers from first_bin on, per_bin in each.  counts: items of each length from 1 to capacity."""
    plain = Plan(counts, capacity)
    plain.best_fit()
    big = {s: n for s, n in counts.items() if s > capacity * large and n}
    if not big:
        return plain.ranges
    members = grouped(big, groups)
    made = Plan(counts, capacity)
    chosen = configurations([m[0] for m in members], [sum(big[s] for s in m) for m in members], capacity)
    for take, times in sorted(chosen, key=lambda c: -c[1]):
        made.fill(members, take, int(times + 1e-9))
    made.best_fit()
    return made.ranges if made.bins <= plain.bins else plain.ranges


def items(token_counts: DataFrame, packs: list[tuple[int, str, int]]) -> DataFrame:
    """pack_id, doc_id, part, n_tokens: whole texts, and the parts of those beyond the capacity."""
    kinds = F.array(*[F.struct(F.lit(p).alias("pack_id"), F.col(f"`{t}`").alias("n"), F.lit(c).alias("capacity")) for p, t, c in packs])
    rows = token_counts.select("doc_id", F.explode(kinds).alias("k")).select("doc_id", "k.*").filter("n > 0")
    rows = rows.select("pack_id", "doc_id", "n", "capacity", F.explode(F.expr("sequence(0, (n - 1) div capacity)")).alias("part"))
    return rows.select("pack_id", "doc_id", F.col("part").cast("int").alias("part"), F.least(F.col("capacity"), F.col("n") - F.col("part") * F.col("capacity")).cast("int").alias("n_tokens"))


def pack(spark: SparkSession, docs: DataFrame, pack_sizes: DataFrame, folder: str | None = None) -> DataFrame:
    """pack_id, bin_id, doc_id, part, n_tokens: the container of every item, for each kind of container."""
    kinds = pack_sizes.select("pack_id", "tokenizer", "capacity").filter("pack_id is not null and tokenizer is not null and capacity > 0").distinct()
    packs = sorted((r.pack_id, r.tokenizer, r.capacity) for r in kinds.collect())  # a list of parameters
    schema = "pack_id int, bin_id bigint, doc_id bigint, part int, n_tokens int"
    if not packs:
        return spark.createDataFrame([], schema)
    tokens = cut(lengths(docs, sorted({t for _, t, _ in packs}), folder), "lengths")  # tokenized once, read twice
    all_items = items(tokens, packs)
    counts: dict[int, dict[int, int]] = defaultdict(dict)
    for r in all_items.groupBy("pack_id", "n_tokens").count().collect():  # at most a count for each length of each kind
        counts[r.pack_id][r.n_tokens] = r["count"]
    ranges = [(p, *r) for p, _, capacity in packs for r in plan(counts[p], capacity)]
    planned = spark.createDataFrame(ranges, "pack_id int, n_tokens int, rank_from bigint, rank_to bigint, first_bin bigint, per_bin bigint, n_bins bigint")
    # a range stands in every block of ranks that it meets, so an item looks only at those of its own block
    planned = planned.select("pack_id", "n_tokens", F.explode(F.expr(f"sequence(rank_from div {BLOCK}, (rank_to - 1) div {BLOCK})")).alias("block"), F.struct("rank_from", "rank_to", "first_bin", "per_bin").alias("r"))
    planned = planned.groupBy("pack_id", "n_tokens", "block").agg(F.collect_list("r").alias("ranges"))
    # the most frequent length, however many items have it, is ranked in buckets of about BUCKET_ROWS
    buckets = 1 + max((n for c in counts.values() for n in c.values()), default=0) // BUCKET_ROWS
    all_items = all_items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "part"), F.lit(buckets)).cast("int"))
    sums = all_items.groupBy("pack_id", "n_tokens", "bucket").count()
    offset = F.coalesce(F.sum("count").over(W.partitionBy("pack_id", "n_tokens").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("pack_id", "n_tokens", "bucket", offset.alias("offset"))
    rank = F.row_number().over(W.partitionBy("pack_id", "n_tokens", "bucket").orderBy("doc_id", "part")) - 1
    ranked = all_items.withColumn("rank", rank).join(sums, ["pack_id", "n_tokens", "bucket"]).withColumn("rank", F.col("rank") + F.col("offset"))
    ranked = ranked.withColumn("block", F.expr(f"rank div {BLOCK}"))
    found = ranked.join(planned, ["pack_id", "n_tokens", "block"]).withColumn("r", F.expr("filter(ranges, r -> rank >= r.rank_from and rank < r.rank_to)[0]"))
    return found.select("pack_id", (F.col("r.first_bin") + F.expr("(rank - r.rank_from) div r.per_bin")).alias("bin_id"), "doc_id", "part", "n_tokens")


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """The container of every text of documents, for each row of pack_sizes."""
    return pack(spark, spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/pack_sizes.parquet"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """pack_id, n_bins, n_items, n_tokens, least_bins (tokens / capacity, rounded up), most_in_bin, fill."""
    bins = p7_packed(spark, d).groupBy("pack_id", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    sizes = spark.read.parquet(f"{d}/pack_sizes.parquet").select("pack_id", "capacity")
    out = bins.groupBy("pack_id").agg(F.count(F.lit(1)).alias("n_bins"), F.sum("n").alias("n_items"), F.sum("t").alias("n_tokens"), F.max("t").alias("most_in_bin")).join(sizes, "pack_id")
    out = out.withColumn("least_bins", F.ceil(F.col("n_tokens") / F.col("capacity")))
    return out.withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity")), 6)).drop("capacity")


def p7_parts(spark: SparkSession, d: str) -> DataFrame:
    """pack_id, doc_id, part, n_tokens of parts by characters in place of tokens: how texts are cut, in a form that SQL can follow."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    counts = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"))
    packs = sorted((r.pack_id, "chars", r.capacity) for r in spark.read.parquet(f"{d}/pack_sizes.parquet").select("pack_id", "capacity").filter("pack_id is not null and capacity > 0").distinct().collect())
    return items(counts, packs)


SQL = {"p7_parts": "SELECT pack_id, doc_id, CAST(part AS INTEGER) AS part, CAST(least(capacity, n - part * capacity) AS INTEGER) AS n_tokens FROM (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents), (SELECT DISTINCT pack_id, capacity FROM pack_sizes WHERE pack_id IS NOT NULL AND capacity > 0), LATERAL (SELECT unnest(range(0, (n - 1) // capacity + 1)) AS part) WHERE n > 0"}
