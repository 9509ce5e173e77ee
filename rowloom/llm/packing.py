"""Best-fit packing of token pieces by a configuration linear program.

Texts become token pieces of at most ``capacity`` ids. The pieces' length
histogram, at most ``capacity`` numbers however large the corpus, is all that
reaches the driver. There the configuration program (how often to use each
combination of lengths that fits a sequence) is solved by multiplicative
weights on groups of neighbouring lengths, with a knapsack by dynamic programming
that prices new combinations, up to a proven gap. The fractional solution is
rounded to whole sequences of real lengths; those that would leave much room, and
what is then left over, are packed best-fit decreasing, all on the histogram.
Pieces find their places by their rank among pieces of equal length,
counted per task and added up in Spark.

* null and empty texts are one piece with the end id only;
* repeated rows are packed each; an empty table gives an empty result;
* only texts of more than ``capacity`` ids are cut.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowloom.llm.common import small, stored
from rowloom.llm.tokens import word_tokens

#: Groups of neighbouring lengths in the program; most prices asked for, steps between two, their size; the gap to end at.
GROUPS, PRICES, STEPS, RATE, GAP = 200, 400, 400, 0.1, 0.02
#: A sequence with more room than this share is left to best fit.
WASTE = 1 / 512
#: Prices are mostly those of the best proven bound, so that new patterns suit the ones there are.
STAY = 0.8


def knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each capacity the greatest value of lengths within it, any number of each, and one of them (-1: none)."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for j, (length, v) in enumerate(zip(lengths.tolist(), value.tolist())):
        # A row for each turn of the length: in a column, the best start and a value for each turn since.
        turns = -(-(capacity + 1) // length)
        grid = np.full(turns * length, -np.inf)
        grid[: capacity + 1] = best
        rise = (np.arange(turns) * v)[:, None]
        more = (np.maximum.accumulate(grid.reshape(turns, length) - rise, axis=0) + rise).ravel()[: capacity + 1]
        better = more > best + 1e-12
        best[better], choice[better] = more[better], j
    return best, choice


def pattern_of(lengths: np.ndarray, choice: np.ndarray, capacity: int) -> list[int]:
    """The lengths, by index, behind a capacity's greatest value."""
    out = []
    while choice[capacity] >= 0:
        out.append(int(choice[capacity]))
        capacity -= int(lengths[choice[capacity]])
    return out


def best_pattern(lengths: np.ndarray, value: np.ndarray, capacity: int) -> list[int]:
    """The multiset of lengths within capacity with the greatest value."""
    return pattern_of(lengths, knapsack(lengths, value, capacity)[1], capacity)


def length_groups(lengths: np.ndarray, demand: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The group of each ascending length: neighbours, with about equal tokens, numbered without gaps.

    A rare length alone would hold back every pattern that it is in.
    """
    tokens = np.cumsum(lengths * demand)
    return np.unique(np.ceil(tokens / tokens[-1] * groups).astype(np.int64), return_inverse=True)[1]


@dataclass(frozen=True)
class Program:
    """A solved configuration program: patterns (indices of lengths) and how often to use each.

    ``use`` covers all demand. ``bound``: no covering has fewer sequences, by
    the best prices as a dual solution.
    """

    patterns: list[tuple[int, ...]]
    use: np.ndarray
    bound: float

    @property
    def gap(self) -> float:
        return float(self.use.sum() / self.bound - 1)


def _shares(logs: np.ndarray) -> np.ndarray:
    weight = np.exp(logs - logs.max())
    return weight / weight.sum()


def configuration_program(lengths: np.ndarray, demand: np.ndarray, capacity: int, prices: int = PRICES, gap: float = GAP) -> Program:
    """The covering program by multiplicative weights, on patterns and on lengths.

    Patterns gain weight by the lengths they serve, lengths lose it by the
    patterns that serve them, each step looking ahead by its last change. The
    steps' mean is the solution. Every ``STEPS`` a knapsack prices, for each
    length, the best pattern that holds it; that is also the dual bound.
    """
    m, least = len(lengths), float(lengths @ demand) / capacity
    known = {(j,) * (capacity // n): j for j, n in enumerate(lengths.tolist())}
    served = np.diag(capacity // lengths) * (least / demand)
    logs, price_logs = np.zeros(m), np.zeros(m)
    price, centre, bound, best = np.ones(m) / m, np.ones(m) / m, 0.0, (math.inf, np.zeros(0))
    for _ in range(prices):
        top, choice = knapsack(lengths, price / demand, capacity)
        if (now := float(price.sum() / top[capacity])) > bound:
            bound, centre = now, price
        if best[0] <= bound * (1 + gap):
            break
        fresh = [tuple(sorted([j, *pattern_of(lengths, choice, capacity - n)])) for j, n in enumerate(lengths.tolist())]
        fresh = [p for p in dict.fromkeys(fresh) if p not in known]
        known |= {p: len(known) + i for i, p in enumerate(fresh)}
        rows = np.array([np.bincount(p, minlength=m) for p in fresh]).reshape(-1, m) * (least / demand)
        served = np.vstack([served, rows])
        logs = np.concatenate([logs, np.full(len(fresh), logs.max() - 4)])
        use, price_mean, last = np.zeros(len(logs)), np.zeros(m), None
        for _ in range(STEPS):
            x, w = _shares(logs), _shares(price_logs)
            gain = served @ w, x @ served
            last = last or gain
            logs = logs + RATE * (2 * gain[0] - last[0])
            price_logs = price_logs - RATE * (2 * gain[1] - last[1])
            use, price_mean, last = use + x / STEPS, price_mean + w / STEPS, gain
        covered = float((use @ served).min())
        if covered > 0 and least / covered < best[0]:
            best = least / covered, use * (least / covered)
        price = STAY * centre + (1 - STAY) * price_mean
    patterns = list(known)[: len(best[1])]
    return Program(patterns, best[1], bound)


def best_fit(lengths: list[int], counts: list[int], capacity: int, begun: Counter | None = None) -> Counter:
    """Best-fit decreasing on a histogram: patterns of lengths and how often each is used, those ``begun`` included."""
    room: dict[int, Counter] = defaultdict(Counter)
    for pattern, n in (begun or {}).items():
        room[capacity - sum(pattern)][pattern] += n
    for length, left in sorted(zip(lengths, counts), reverse=True):
        while left:
            at = min((r for r, bins in room.items() if r >= length and bins), default=None)
            if at is None:
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    room[capacity - each * length][(length,) * each] += full
                if rest:
                    room[capacity - rest * length][(length,) * rest] += 1
                break
            pattern, n = next(iter(room[at].items()))
            fit = min(at // length, left)
            bins = min(n, left // fit)
            room[at][pattern] -= bins
            if not room[at][pattern]:
                del room[at][pattern]
            room[at - fit * length][pattern + (length,) * fit] += bins
            left -= bins * fit
    total: Counter = Counter()
    for bins in room.values():
        total.update(bins)
    return total


def rounded(program: Program, group: np.ndarray, lengths: np.ndarray, left: np.ndarray, capacity: int) -> Counter:
    """Whole uses of the program's patterns, with real lengths for its groups; takes them from ``left``.

    Patterns come by falling use, each rounded up while its groups last. A slot
    takes its group's longest length that is left, the last slot the longest
    that fits, so what rounding up to groups had left open is used.
    """
    plan: Counter = Counter()
    edges = np.searchsorted(group, np.arange(group.max() + 2))
    for k in np.argsort(-program.use, kind="stable").tolist():
        todo = math.ceil(program.use[k] - 1e-6)
        slots = sorted(program.patterns[k], reverse=True)
        while todo > 0:
            taken: Counter = Counter()
            room = capacity
            for i, g in enumerate(slots):
                low, high = edges[g], edges[g + 1]
                if i == len(slots) - 1:
                    high = max(high, np.searchsorted(lengths, room, side="right"))
                at = next((j for j in range(high - 1, low - 1, -1) if left[j] > taken[j]), None)
                if at is None:
                    break
                taken[at] += 1
                room -= int(lengths[at])
            if len(slots) == sum(taken.values()) and room <= WASTE * capacity:
                times = min(todo, *(int(left[j]) // n for j, n in taken.items()))
                for j, n in taken.items():
                    left[j] -= n * times
                plan[tuple(sorted((int(lengths[j]) for j in taken.elements()), reverse=True))] += times
                todo -= times
                continue
            break
    return plan


def program_plan(histogram: dict[int, int], capacity: int) -> tuple[Counter, dict[int, int], Program | None]:
    """Patterns placed through the program, the lengths left over, and the program on groups."""
    rest = {k: v for k, v in histogram.items() if v and k < capacity}
    plan = Counter({(capacity,): histogram[capacity]}) if histogram.get(capacity) else Counter()
    if not rest:
        return plan, {}, None
    lengths = np.array(sorted(rest))
    left = np.array([rest[x] for x in lengths.tolist()])
    group = length_groups(lengths, left)
    longest = np.array([lengths[group == g].max() for g in range(group.max() + 1)])
    program = configuration_program(longest, np.bincount(group, left), capacity)
    plan.update(rounded(program, group, lengths, left, capacity))
    return plan, {int(k): int(v) for k, v in zip(lengths, left) if v}, program


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and their numbers, which use up the histogram exactly."""
    plan, rest, _ = program_plan(histogram, capacity)
    if rest:
        plan = best_fit(list(rest), list(rest.values()), capacity, plan)
    return sorted(plan.items(), reverse=True)


def slot_table(plan) -> tuple[np.ndarray, ...]:
    """For each length and pattern: first rank, first sequence, pieces a sequence, place of the first."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for pattern, n in plan:
        at = 0
        for length in dict.fromkeys(pattern):
            times = pattern.count(length)
            rows.append((length, used[length], sequence, times, at))
            used[length] += n * times
            at += length * times
        sequence += n
    rows.sort()
    return tuple(np.array(x, np.int64) for x in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(5))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, keys: int) -> Iterator[pa.RecordBatch]:
    task, seen = TaskContext.get().partitionId(), Counter()
    encoder = word_tokens(path)
    for batch in batches:
        bodies = [x.as_py() or b"" for x in batch.column(keys).cast(pa.binary())]
        rows, owner = [], []
        for i, ids in encoder.texts(bodies):
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                rows.append((piece, at, len(part), zlib.crc32(part.tobytes()), task, seen[len(part)]))
                owner.append(i)
                seen[len(part)] += 1
        where = pa.array(owner, pa.int64())
        columns = [batch.column(k).take(where) for k in range(keys)]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        values = list(zip(*rows)) if rows else [()] * 6
        columns += [pa.array(v, k) for v, k in zip(values, kinds)]
        names = [f"k{k}" for k in range(keys)] + ["piece", "start", "length", "ids_crc32", "task", "nth"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _placed(batches: Iterator[pa.RecordBatch], slots, keys: int) -> Iterator[pa.RecordBatch]:
    length, first, sequence, times, at = slots
    order = length * (1 << 48) + first
    for batch in batches:
        names = batch.schema.names
        size = batch.column(names.index("length")).to_numpy()
        rank = batch.column(names.index("rank")).to_numpy()
        row = np.searchsorted(order, size * (1 << 48) + rank, side="right") - 1
        inside = rank - first[row]
        columns = [batch.column(k) for k in range(keys + 4)]
        columns += [pa.array(sequence[row] + inside // times[row]), pa.array(at[row] + inside % times[row] * size)]
        yield pa.RecordBatch.from_arrays(columns, names=[*names[: keys + 4], "sequence_id", "offset"])


def packed(docs: DataFrame, tokenizer_path: str, key: list[str], text: str = "text", capacity: int = 2048) -> DataFrame:
    """``key`` columns, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    keys = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(key))
    kinds = f"{keys}, piece int, start bigint, length bigint, ids_crc32 bigint"
    read = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key)), F.col(f"`{text}`").cast("string").alias("t"))
    pieces = stored(
        read.mapInArrow(lambda it: _pieces(it, tokenizer_path, capacity, len(key)), f"{kinds}, task int, nth bigint")
    )
    counts = stored(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(small(offsets), ["task", "length"]).select(
        *(f"k{i}" for i in range(len(key))), "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )
    slots = slot_table(packing_plan(histogram, capacity))
    out = ranked.mapInArrow(lambda it: _placed(it, slots, len(key)), f"{kinds}, sequence_id bigint, offset bigint")
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(key)), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
