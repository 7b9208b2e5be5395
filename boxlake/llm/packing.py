"""Filling fixed-capacity containers with items (problem 6).

The only thing that packing needs of the items is how many there are of each length, and lengths are bounded by the
capacity. Over that histogram the configuration linear program is solved by multiplicative weights: a knapsack dynamic
program prices configurations, and steps of multiplicative weights find how often each is used, in fractions. The dual
prices bound the number of containers from below. The solution is rounded to whole containers, the program is solved
again for what the rounding leaves, and the last containers are filled by the pricing program around their longest
item. Items learn their place from their rank among the items of their length, by arithmetic alone, so neither a
popular length nor the number of items matters.
"""

from __future__ import annotations

import base64
import math
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from boxlake.runtime import written

#: Container size in tokens, and the public tokenizer's vocabulary that measures it.
CAPACITY = 2048
VOCABULARY = os.environ.get("BOXLAKE_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Rounds of pricing, and steps of multiplicative weights per round (LAST times as many in the last one).
ROUNDS, STEPS, LAST = 100, 30, 20
#: How sharply weights follow prices in the first and the last round, and the over-relaxation of a step.
SHARP, RELAX = (0.05, 0.003), 1.5
#: Configurations kept, the least fractional part that is rounded up, the slack of tight ones, containers left to fill one by one.
MOST_COLUMNS, LEAST_PART, SLACK, FEW = 12_000, 0.3, 0.02, 8

# Fixed value: the pre-tokenizer pattern that belongs to the vocabulary.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[path] = tiktoken.Encoding("public", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every row; a null or empty text has 0 tokens. The vocabulary is shipped with the job."""
    documents.sparkSession.sparkContext.addFile(vocabulary)
    shipped = os.path.basename(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(SparkFiles.get(shipped)).encode_ordinary
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(encode(t)) if t else 0 for t in b.column(1).to_pylist()], pa.int64())], [b.schema.names[0], "n_tokens"])

    rows = documents.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`").alias("__text"))
    return rows.mapInArrow(run, rows.drop("__text").schema.add("n_tokens", "long"))


@dataclass(frozen=True)
class Plan:
    """Kinds of containers: kind k is used for times[k] containers, numbered kind after kind.

    The first `by_lp` kinds come from the configuration LP, the others hold what its rounding left. bound is the LP's
    dual value rounded up: no packing needs fewer containers.
    """

    capacity: int
    kinds: tuple[tuple[tuple[int, int], ...], ...]  # per kind: (length, number), longest first
    times: tuple[int, ...]
    by_lp: int = 0
    bound: int = 0

    @property
    def containers(self) -> int:
        return sum(self.times)

    @property
    def lp_containers(self) -> int:
        return sum(self.times[: self.by_lp])


def _units(lengths: np.ndarray, number: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of length, copies) of bundles of 1, 2, 4 ... copies that together allow any number up to `number`."""
    index, copies = [], []
    for i, (x, n) in enumerate(zip(lengths.tolist(), number.tolist(), strict=True)):
        n, size = min(int(n), capacity // x), 1
        while n > 0:
            index.append(i)
            copies.append(min(size, n))
            n -= min(size, n)
            size *= 2
    return np.array(index, np.int64), np.array(copies, np.int64)


class Knapsack:
    """The dynamic program that prices configurations: the most worth within every capacity, each length at most `number` times."""

    def __init__(self, lengths: np.ndarray, number: np.ndarray, capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.index, self.copies = _units(lengths, number, capacity)
        self.size = lengths[self.index] * self.copies

    def solve(self, worth: np.ndarray) -> np.ndarray:
        """The greatest worth within each capacity 0..capacity; contents() then tells how it is reached."""
        value = worth[self.index] * self.copies
        best = np.zeros(self.capacity + 1)
        self.taken = np.zeros((len(self.index), self.capacity + 1), bool)
        for u, (s, v) in enumerate(zip(self.size.tolist(), value.tolist(), strict=True)):
            more = best[: self.capacity + 1 - s] + v
            better = more > best[s:] + 1e-15
            self.taken[u, s:] = better
            best[s:][better] = more[better]
        return best

    def contents(self, capacities: np.ndarray) -> np.ndarray:
        """(len(capacities), lengths) numbers of each length in the best content within each of the capacities."""
        out = np.zeros((len(capacities), len(self.lengths)), np.int32)
        left, rows = capacities.copy(), np.arange(len(capacities))
        for u in range(len(self.index) - 1, -1, -1):
            at = self.taken[u, left]
            if at.any():
                out[rows[at], self.index[u]] += self.copies[u]
                left[at] -= self.size[u]
        return out


class _Columns:
    """Configurations found so far, as sparse columns."""

    def __init__(self, m: int) -> None:
        self.m = m
        self.seen: dict[bytes, int] = {}
        self.col, self.row, self.n = (np.zeros(0, np.int64) for _ in range(3))
        self.count = 0

    def add(self, contents: np.ndarray) -> None:
        new = []
        for c in contents:
            key = c.tobytes()
            if key not in self.seen:
                self.seen[key] = self.count + len(new)
                new.append(c)
        if new:
            c, r = np.nonzero(np.array(new))
            self.col, self.row = np.concatenate([self.col, c + self.count]), np.concatenate([self.row, r])
            self.n = np.concatenate([self.n, np.array(new)[c, r]])
            self.count += len(new)

    def load(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.n * y[self.row], self.count)

    def cover(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.n * x[self.col], self.m)

    def keep(self, which: np.ndarray) -> None:
        """Drops the columns that are not in the mask."""
        to = np.cumsum(which) - 1
        held = which[self.col]
        self.col, self.row, self.n = to[self.col[held]], self.row[held], self.n[held]
        self.seen = {k: int(to[i]) for k, i in self.seen.items() if which[i]}
        self.count = int(which.sum())

    def content(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.searchsorted(self.col, [i, i + 1])
        return self.row[lo:hi], self.n[lo:hi]


def configuration_lp(lengths: np.ndarray, need: np.ndarray, capacity: int, rounds: int = ROUNDS, steps: int = STEPS) -> tuple[_Columns, np.ndarray, np.ndarray, float]:
    """(columns, x, y, bound): the fractional configuration LP by multiplicative weights.

    min sum(x) over configurations so that every length is covered `need` times. A configuration's share x is the
    exponential weight of how far the prices y of its contents exceed one container; each step multiplies the weights of
    all configurations that hold a length by a power of how far it is covered too little or too often, which is a change
    of its price. The power is the length's share of the container, so that the powers of one configuration sum to one
    at most and the steps converge. Each round the knapsack program finds, for every length, the dearest configuration
    that holds it; every other round among a random part of the lengths, for variety. The weights sharpen over the
    rounds. bound is the best dual value: what the needed items cost, over the dearest configuration's price.
    """
    m, part = len(lengths), lengths / capacity
    sack, columns = Knapsack(lengths, need, capacity), _Columns(m)
    y, best_y, bound = part.copy(), part.copy(), 0.0
    scale = float((part * need).sum()) / m
    x = np.zeros(0)
    for t in range(rounds + 1):
        sharp = SHARP[0] * (SHARP[1] / SHARP[0]) ** min(1.0, t / max(1, rounds - 1))
        dearest = float(sack.solve(y)[capacity])
        if (value := float((need * y).sum()) / dearest) > bound:
            bound, best_y = value, y / dearest
        if t == rounds:
            break
        y = y / max(dearest, 1.0)
        found = [sack.contents(np.array([capacity]))]
        if t % 2:
            sack.solve(np.where(np.random.default_rng(t).random(m) < 0.5, y, 0.0))
        beside = sack.contents(capacity - lengths)
        beside[np.arange(m), np.arange(m)] += 1
        columns.add(np.concatenate([*found, beside[(beside <= need).all(1)]]))
        if columns.count > MOST_COLUMNS:
            load = columns.load(y)
            columns.keep(load >= np.sort(load)[-MOST_COLUMNS // 2])
        for _ in range(steps if t < rounds - 1 else steps * LAST):
            x = scale * np.exp(np.clip((columns.load(y) - 1) / sharp, -50, 50))
            over = np.log(np.maximum(columns.cover(x) / need, 1e-9))
            y = np.maximum(y - RELAX * sharp * part * np.clip(over, -9, 9), 0.0)
    return columns, x, best_y, bound


def plan_containers(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS, steps: int = STEPS) -> Plan:
    """Containers for every item of a histogram {length: number} of lengths 1..capacity.

    The LP's solution is rounded down, then its configurations are taken once by their fractional part and, the
    tightest first, as often as their contents remain; the LP is solved again for what is left. Once a few containers
    are left (or a round takes nothing), the knapsack program fills each around its longest item at the LP's prices.
    The work depends on the capacity alone, not on the number of items.
    """
    lengths = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    rounded: Counter = Counter()
    rest: Counter = Counter()
    bound, y = 0.0, lengths / capacity

    def take(kinds: Counter, rows: np.ndarray, numbers: np.ndarray, times: int) -> None:
        kinds[tuple(sorted(zip(lengths[rows].tolist(), numbers.tolist(), strict=True), reverse=True))] += times
        left[rows] -= numbers * times

    first = True
    while first and left.any() or int((lengths * left).sum()) > FEW * capacity:
        at, before = np.nonzero(left)[0], int(left.sum())
        columns, x, prices, value = configuration_lp(lengths[at], left[at].astype(float), capacity, rounds, steps)
        y[at] = prices
        bound, first = (value if first else bound), False
        contents = [columns.content(i) for i in range(columns.count)]
        load, part = columns.load(prices), x - np.floor(x)
        passes = ((np.argsort(-x, kind="stable"), np.floor(x)), (np.argsort(-part, kind="stable"), (part > LEAST_PART).astype(float)), (np.argsort(-load, kind="stable"), np.where(load > 1 - SLACK, np.inf, 0.0)))
        for order, most in passes:
            for i in order.tolist():
                if most[i] >= 1:
                    rows, numbers = at[contents[i][0]], contents[i][1]
                    if times := int(min(most[i], (left[rows] // numbers).min())):
                        take(rounded, rows, numbers, times)
        if int(left.sum()) == before:
            break
    while left.any():
        at = np.nonzero(left)[0]
        top, have = at[-1], left[at].copy()
        have[-1] -= 1
        room = capacity - int(lengths[top])
        small = (lengths[at] <= room) & (have > 0)
        numbers = np.zeros(len(at), np.int64)
        if small.any():
            sack = Knapsack(lengths[at][small], have[small], room)
            sack.solve(y[at][small] + 1e-9 * lengths[at][small])
            numbers[small] = sack.contents(np.array([room]))[0]
        numbers[-1] += 1
        held = np.nonzero(numbers)[0]
        take(rest, at[held], numbers[held], int((left[at[held]] // numbers[held]).min()))
    kinds = [*sorted(rounded.items(), reverse=True), *sorted(rest.items(), reverse=True)]
    return Plan(capacity, tuple(k for k, _ in kinds), tuple(n for _, n in kinds), len(rounded), math.ceil(bound - 1e-6))


class _Places:
    """Where the r-th item of a length goes, as arrays per length."""

    def __init__(self, plan: Plan) -> None:
        self.first = np.concatenate([[0], np.cumsum(plan.times)]).astype(np.int64)
        self.used = np.array([sum(x * k for x, k in kind) for kind in plan.kinds], np.int64)
        self.items = np.array([sum(k for _, k in kind) for kind in plan.kinds], np.int64)
        rows: dict[int, list] = {}
        for i, (kind, times) in enumerate(zip(plan.kinds, plan.times, strict=True)):
            at = slot = 0
            for length, k in kind:
                rows.setdefault(length, []).append((i, k, times * k, at, slot))
                at, slot = at + length * k, slot + k
        self.by_length = {}
        for length, r in rows.items():
            a = np.array(r, np.int64)
            self.by_length[length] = (np.concatenate([[0], np.cumsum(a[:, 2])]), a)

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(container, start, slot) of items of one length by rank."""
        if length == 0:
            n = int(self.first[-1])
            if not n:
                return np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64), rank
            container = rank % n
            kind = np.searchsorted(self.first, container, "right") - 1
            return container, self.used[kind], self.items[kind] + rank // n
        starts, a = self.by_length[length]
        j = np.searchsorted(starts, rank, "right") - 1
        within = rank - starts[j]
        kind, each = a[j, 0], a[j, 1]
        copy = within % each
        return self.first[kind] + within // each, a[j, 3] + copy * length, a[j, 4] + copy


def packed(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, rounds: int = ROUNDS, steps: int = STEPS) -> DataFrame:
    """(key, piece, container_id, slot, start, length) of every row of items, as plan_and_place() returns them."""
    return plan_and_place(items, key, size, capacity, rounds, steps)[1]


def plan_and_place(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, rounds: int = ROUNDS, steps: int = STEPS) -> tuple[Plan, DataFrame]:
    """The plan and (key, piece, container_id, slot, start, length) of every row of items.

    An item longer than the capacity is cut into pieces of the capacity and a rest; no other is cut. Items of length 0
    or null are spread over the containers behind their other items. Rows with equal keys are different items.
    """
    cut = F.when(F.coalesce(F.col(f"`{size}`"), F.lit(0)) <= capacity, F.array(F.greatest(F.coalesce(F.col(f"`{size}`"), F.lit(0)), F.lit(0)).cast("bigint")))
    whole = F.array_repeat(F.lit(capacity).cast("bigint"), (F.col(f"`{size}`") / capacity).cast("int"))
    rest = F.col(f"`{size}`") % capacity
    cut = cut.otherwise(F.when(rest > 0, F.array_append(whole, rest.cast("bigint"))).otherwise(whole))
    pieces = items.select(F.col(f"`{key}`").alias("__k"), F.posexplode(cut).alias("piece", "length")).withColumn("part", F.spark_partition_id())

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for b in batches:
            lengths = np.asarray(b.column(2))
            rank = np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, starts = np.unique(lengths[order], return_index=True)
            for v, lo, hi in zip(values.tolist(), starts, [*starts[1:], len(lengths)], strict=True):
                rank[order[lo:hi]] = seen[v] + np.arange(hi - lo)
                seen[v] += int(hi - lo)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank)], [*b.schema.names, "rank"])

    pieces = written(pieces.mapInArrow(ranked, T.StructType([*pieces.schema.fields, T.StructField("rank", T.LongType())])), "pieces")
    # One row per task and length; a length's row numbers begin where those of the tasks before end.
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # The histogram has at most capacity + 1 rows, whatever the number of items.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).filter("length > 0").collect()}
    plan = plan_containers(histogram, capacity, rounds, steps)
    places = _Places(plan)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, rank = np.asarray(b.column(2)), np.asarray(b.column(3))
            container, start, slot = (np.empty(len(lengths), np.int64) for _ in range(3))
            order = np.argsort(lengths, kind="stable")
            values, starts = np.unique(lengths[order], return_index=True)
            for v, lo, hi in zip(values.tolist(), starts, [*starts[1:], len(lengths)], strict=True):
                at = order[lo:hi]
                container[at], start[at], slot[at] = places.place(v, rank[at])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(container), pa.array(slot), pa.array(start), b.column(2)], [key, "piece", "container_id", "slot", "start", "length"])

    placed = pieces.join(offsets, ["part", "length"]).select("__k", "piece", "length", (F.col("rank") + F.col("before")).alias("rank"))
    schema = items.select(F.col(f"`{key}`").alias(key)).schema.add("piece", "integer").add("container_id", "long").add("slot", "long").add("start", "long").add("length", "long")
    return plan, placed.mapInArrow(assign, schema)


def fill(plan: Plan, placed: DataFrame) -> DataFrame:
    """One row: items, containers, tokens, the share of capacity left unused, the LP's bound on containers, and the share
    of items (without those of length 0) in configurations taken from the LP's own columns."""
    capacity = plan.capacity
    held = [sum(k for _, k in kind) * n for kind, n in zip(plan.kinds, plan.times, strict=True)]
    share = round(sum(held[: plan.by_lp]) / sum(held), 6) if held else 1.0
    per = placed.groupBy("container_id").agg(F.sum("length").alias("used"), F.count("*").alias("n"))
    total = per.agg(F.sum("n").alias("n_pieces"), F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"))
    return total.withColumn("unused_share", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * capacity), 6)).withColumns({"lp_bound": F.lit(plan.bound).cast("bigint"), "lp_share": F.lit(share)})
