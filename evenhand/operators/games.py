"""The game between a classifier and the multipliers of its constraints.

A constraint says that the rate of predicted ones in a group (and event) is close to that of the event. Events are all rows
(parity) or the two labels (odds). The state is a row for each group: its counts, its multipliers, and its difference to
the event's rate for every classifier so far. ``Few`` keeps it in arrays on the driver, ``Many`` in a table that is updated by joins and
read by aggregations; both hand the driver the same few numbers, and the rows of at most ``ACTIVE`` constraints.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.operators.lookup import GroupTable, attach, local_table
from evenhand.session import cut_lineage

#: Groups whose state the driver holds; further ones are kept in a table.
FEW_GROUPS = 100_000
#: Constraints that weights of a mixture are looked for with; the gap itself is always that of all.
ACTIVE = 512
ROUNDS = 3000
STRENGTH = 20.0
RATE = 0.3


#: Groups whose weights are written into the expressions instead of being joined.
LITERAL_GROUPS = 1_000


@dataclass(frozen=True)
class Weighting:
    """Weights and labels of a cost-sensitive fit: arrays or a table by cell (group, label), or one class for all."""

    constant: int | None
    cells: tuple[np.ndarray, np.ndarray] | None = None
    table: GroupTable | None = None

    def of(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """The features with ``__label`` and ``__weight``."""
        if self.cells is not None:
            at = F.col("__g") * 2 + F.col("__y")
            weight, label = (F.lit([float(v) for v in c.ravel()])[at] for c in self.cells)
            return rows.select(*names, label.alias("__label"), weight.alias("__weight"))
        held = attach(rows, self.table, ["__g", "__y"], [*names, "__g"])
        return held.select(*names, F.col("__label").cast("double").alias("__label"), "__weight")


class Moments:
    """Counts of the constraint on the driver: events are all rows (parity) or the two labels (odds)."""

    def __init__(self, constraint: str, counts: np.ndarray, reweighting: bool = False) -> None:
        self.weight = np.ones(counts.shape)
        if reweighting:
            expected = counts.sum(axis=1)[:, None] * counts.sum(axis=0)[None, :] / counts.sum()
            self.weight = self._divide(expected, counts)
        self.by_label = constraint == "equalized_odds"
        self.counts = counts
        self.n = counts.sum()
        self.group = counts.T if self.by_label else counts.sum(axis=1)[None, :]
        self.event = self.group.sum(axis=1)
        self.shape = self.group.shape

    @staticmethod
    def _divide(a, b):
        return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b > 0)

    def differences(self, votes: np.ndarray) -> np.ndarray:
        """Rate of predicted ones in each (event, group) minus that of the event."""
        ones = votes.T if self.by_label else votes.sum(axis=1)[None, :]
        rates = self._divide(ones, self.group)
        overall = self._divide(ones.sum(axis=1), self.event)[:, None]
        return np.where(self.group > 0, rates - overall, 0.0)

    def costs(self, multipliers: np.ndarray) -> np.ndarray:
        """Cost of predicting 1 per (group, label), from the signed multipliers."""
        per_group = self._divide(multipliers, self.group)
        per_event = self._divide(multipliers.sum(axis=1), self.event)[:, None]
        penalty = per_group - per_event
        error = self.weight * (1.0 - 2.0 * np.array([0.0, 1.0]))[None, :] / self.n
        return error + (penalty.T if self.by_label else np.repeat(penalty.T, 2, axis=1))

    def error(self, votes: np.ndarray) -> float:
        """Weighted share of wrong predictions."""
        wrong = np.column_stack([votes[:, 0], self.counts[:, 1] - votes[:, 1]])
        return float((self.weight * wrong).sum() / self.n)


class Few:
    """State on the driver, for at most ``FEW_GROUPS`` groups numbered from 0 in ``__g``."""

    def __init__(self, rows: DataFrame, groups: int, constraint: str, reweighting: bool) -> None:
        self.groups, self.rows = groups, rows
        self.moments = Moments(constraint, self._cells(rows, F.lit(1)), reweighting)
        self.theta = np.zeros((2, *self.moments.shape))
        self.found: list[np.ndarray] = []

    def _cells(self, df: DataFrame, value: Column) -> np.ndarray:
        """Sum of ``value`` per (group, label): one aggregation, two rows per group."""
        sums = np.zeros((self.groups, 2))
        for r in df.groupBy("__g", "__y").agg(F.sum(value.cast("double")).alias("s")).collect():
            sums[r["__g"], r["__y"]] = r["s"]
        return sums

    def weighting(self, bound: float) -> Weighting:
        """The weights and labels for which the best classifier answers the multipliers."""
        top = max(self.theta.max(), 0.0)
        lift = np.exp(self.theta - top)
        multipliers = bound * lift / (np.exp(-top) + lift.sum())
        cost, counts = self.moments.costs(multipliers[0] - multipliers[1]), self.moments.counts
        weight, relabel = np.abs(cost), (cost < 0).astype(int)
        mass = float((weight * counts).sum())
        used = set(relabel[(counts > 0) & (weight > 0)].tolist())
        if mass == 0 or len(used) <= 1:
            return Weighting(used.pop() if used else 0)
        weight = weight * self.moments.n / mass
        if self.groups <= LITERAL_GROUPS:
            return Weighting(None, (weight, relabel))
        rows = [(g, y, float(weight[g, y]), int(relabel[g, y])) for g in range(self.groups) for y in (0, 1)]
        table = local_table(self.rows.sparkSession, rows, "__g int, __y int, __weight double, __label int", 2 * FEW_GROUPS)
        return Weighting(None, None, table)

    def record(self, voted: DataFrame) -> tuple[float, float]:
        """Take in the predictions ``__h``: the classifier's own gap, and its error."""
        votes = self._cells(voted, F.col("__h"))
        self.found.append(self.moments.differences(votes))
        return float(np.abs(self.found[-1]).max(initial=0.0)), self.moments.error(votes)

    def gaps(self, mixtures: np.ndarray) -> np.ndarray:
        """Largest difference of each mixture of the classifiers so far."""
        found = np.array(self.found).reshape(len(self.found), -1)
        return np.array([np.abs(q @ found).max(initial=0.0) for q in mixtures])

    def active(self, mixture: np.ndarray) -> np.ndarray:
        """The rows (a difference for each classifier) of the constraints that matter most."""
        found = np.array(self.found).reshape(len(self.found), -1).T
        return _foremost(found, mixture)

    def move(self, step: float, eps: float) -> None:
        last = self.found[-1]
        self.theta = self.theta + step * (np.stack([last, -last]) - eps)


def _foremost(found: np.ndarray, mixture: np.ndarray, limit: int | None = None) -> np.ndarray:
    """At most ``limit`` rows: half by the mixture's difference, half by the largest of any classifier."""
    limit = ACTIVE if limit is None else limit
    if len(found) <= limit:
        return found
    half = limit // 2
    first = np.argsort(-np.abs(found @ mixture), kind="stable")[:half]
    rest = np.argsort(-np.abs(found).max(axis=1), kind="stable")[:half]
    return found[np.unique(np.concatenate([first, rest]))]


class Many:
    """State in a table of one row per group, for any number of groups numbered in ``__g``.

    Columns: counts ``c0, c1`` and error weights ``w0, w1`` by label, multipliers ``up, down`` by event, and ``found``, the
    differences of all classifiers so far, event by event.
    """

    def __init__(self, rows: DataFrame, groups: int, constraint: str, reweighting: bool) -> None:
        self.by_label = constraint == "equalized_odds"
        self.events = 2 if self.by_label else 1
        self.members = 0
        counted = rows.groupBy("__g").agg(*[F.count_if(F.col("__y") == y).cast("double").alias(f"c{y}") for y in (0, 1)])
        zero = F.array(*[F.lit(0.0)] * self.events)
        state = cut_lineage(counted.select("*", zero.alias("up"), zero.alias("down"), F.array().cast("array<double>").alias("found")))
        label = state.agg(F.sum("c0"), F.sum("c1")).first()
        self.label = [float(v or 0) for v in label]
        self.n = sum(self.label)
        self.event = self.label if self.by_label else [self.n]
        whole = F.col("c0") + F.col("c1")
        weights = [F.lit(1.0)] * 2
        if reweighting:
            weights = [F.when(F.col(f"c{y}") > 0, whole * (self.label[y] / self.n) / F.col(f"c{y}")).otherwise(0.0) for y in (0, 1)]
        self.state = state.withColumns({f"w{y}": weights[y] for y in (0, 1)})

    def _group(self, event: int) -> Column:
        return F.col(f"c{event}") if self.by_label else F.col("c0") + F.col("c1")

    def weighting(self, bound: float) -> Weighting:
        tops = self.state.agg(F.max(F.array_max("up")), F.max(F.array_max("down"))).first()
        top = max([0.0, *[v for v in tops if v is not None]])
        lifts = [[F.exp(F.col(side)[e] - F.lit(top)) for e in range(self.events)] for side in ("up", "down")]
        sums = self.state.agg(*[F.sum(x) for side in lifts for x in side]).first()
        scale = bound / (np.exp(-top) + sum(sums))
        costs = []
        for y in (0, 1):
            e = y if self.by_label else 0
            group, own = self._group(e), (lifts[0][e] - lifts[1][e]) * F.lit(scale)
            whole = scale * (sums[e] - sums[self.events + e])
            penalty = F.when(group > 0, own / group).otherwise(0.0) - F.lit(whole / self.event[e] if self.event[e] else 0.0)
            costs.append(F.col(f"w{y}") * F.lit((1.0 - 2.0 * y) / self.n) + penalty)
        priced = self.state.select("__g", "c0", "c1", *[c.alias(f"cost{y}") for y, c in enumerate(costs)])
        present = [(F.col(f"c{y}") > 0) & (F.col(f"cost{y}") != 0) for y in (0, 1)]
        ones = [F.max(F.when(present[y], (F.col(f"cost{y}") < 0).cast("int"))) for y in (0, 1)]
        none = [F.min(F.when(present[y], (F.col(f"cost{y}") < 0).cast("int"))) for y in (0, 1)]
        masses = F.sum(F.abs("cost0") * F.col("c0") + F.abs("cost1") * F.col("c1"))
        mass, *used = priced.agg(masses, *ones, *none).first()
        classes = {u for u in used if u is not None}
        if not mass or len(classes) <= 1:
            return Weighting(classes.pop() if classes else 0)
        cells = F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(y).alias("__y"),
                        (F.abs(f"cost{y}") * F.lit(self.n / mass)).alias("__weight"),
                        (F.col(f"cost{y}") < 0).cast("int").alias("__label"),
                    )
                    for y in (0, 1)
                ]
            )
        )
        return Weighting(None, None, GroupTable(cut_lineage(priced.select("__g", cells)), False))

    def record(self, voted: DataFrame) -> tuple[float, float]:
        votes = voted.groupBy("__g").agg(*[F.sum(F.when(F.col("__y") == y, F.col("__h").cast("double")).otherwise(0.0)).alias(f"v{y}") for y in (0, 1)])
        both = cut_lineage(self.state.join(votes, "__g"))
        wrong = F.sum(F.col("w0") * F.col("v0") + F.col("w1") * (F.col("c1") - F.col("v1")))
        v0, v1, error = both.agg(F.sum("v0"), F.sum("v1"), wrong).first()
        ones = [v0, v1] if self.by_label else [v0 + v1]
        new = []
        for e in range(self.events):
            voted_ones = F.col(f"v{e}") if self.by_label else F.col("v0") + F.col("v1")
            overall = ones[e] / self.event[e] if self.event[e] else 0.0
            new.append(F.when(self._group(e) > 0, voted_ones / self._group(e) - F.lit(overall)).otherwise(0.0))
        self.state = cut_lineage(both.withColumn("found", F.concat("found", F.array(*new))).drop("v0", "v1"))
        self.members += 1
        last = np.zeros(self.members)
        last[-1] = 1.0
        return float(self.gaps(last[None, :])[0]), float(error / self.n)

    def gaps(self, mixtures: np.ndarray) -> np.ndarray:
        events, members = self.events, self.members

        def largest(batches):
            most = np.zeros(len(mixtures))
            for batch in batches:
                rows = batch["found"].flatten().to_numpy().reshape(-1, members, events)
                for e in range(events):
                    most = np.maximum(most, np.abs(rows[:, :, e] @ mixtures.T).max(axis=0, initial=0.0))
            yield pa.record_batch({"i": pa.array(np.arange(len(most)), pa.int32()), "gap": pa.array(most)})

        found = self.state.select("found").mapInArrow(largest, "i int, gap double").groupBy("i").agg(F.max("gap").alias("gap"))
        out = np.zeros(len(mixtures))
        for r in found.collect():
            out[r["i"]] = r["gap"]
        return out

    def active(self, mixture: np.ndarray) -> np.ndarray:
        """The foremost of each task's rows, and of those the foremost of all."""
        events, members, limit = self.events, self.members, ACTIVE

        def foremost(batches):
            kept = np.zeros((0, members))
            for batch in batches:
                rows = batch["found"].flatten().to_numpy().reshape(-1, members, events)
                rows = np.concatenate([rows[:, :, e] for e in range(events)])
                kept = _foremost(np.concatenate([kept, rows]), mixture, limit)
            by = np.abs(kept @ mixture)
            yield pa.record_batch({"row": pa.array(kept.tolist(), pa.list_(pa.float64())), "by": pa.array(by), "most": pa.array(np.abs(kept).max(axis=1, initial=0.0))})

        kept = self.state.select("found").mapInArrow(foremost, "row array<double>, by double, most double")
        first = kept.orderBy(F.desc("by"), "row").limit(limit).collect()
        rest = kept.orderBy(F.desc("most"), "row").limit(limit).collect()
        rows = np.unique(np.array([r["row"] for r in first + rest]).reshape(-1, members), axis=0)
        return _foremost(rows, mixture, limit)

    def move(self, step: float, eps: float) -> None:
        last = [F.element_at("found", e - self.events) for e in range(self.events)]
        up = F.array(*[F.col("up")[e] + F.lit(step) * (last[e] - F.lit(eps)) for e in range(self.events)])
        down = F.array(*[F.col("down")[e] + F.lit(step) * (-last[e] - F.lit(eps)) for e in range(self.events)])
        self.state = cut_lineage(self.state.withColumns({"up": up, "down": down}))


def mixture_weights(errors: np.ndarray, rows: np.ndarray, eps: float) -> np.ndarray:
    """Weights of classifiers with little error whose differences stay within ``eps`` on the given rows.

    The two sides of the small game take turns with multiplicative weights; the later half of their turns is averaged.
    """
    bounds = np.concatenate([rows, -rows]) - 0.98 * eps
    mine, theirs = np.zeros(len(errors)), np.zeros(len(bounds) + 1)
    before_mine, before_theirs, total = np.zeros_like(mine), np.zeros_like(theirs), np.zeros_like(mine)

    def share(x: np.ndarray) -> np.ndarray:
        e = np.exp(x - x.max())
        return e / e.sum()

    for i in range(ROUNDS):
        q, m = share(mine), share(theirs) * STRENGTH
        slope = errors + m[:-1] @ bounds
        gain = np.append(bounds @ q, 0.0) * STRENGTH
        mine = mine - RATE * (2 * slope - before_mine)
        theirs = theirs + RATE * (2 * gain - before_theirs)
        before_mine, before_theirs = slope, gain
        if i >= ROUNDS // 2:
            total += q
    return total / total.sum()


def mix(game: Few | Many, errors: list[float], constants: tuple[float, float], tolerance: float, before: np.ndarray | None):
    """Weights of the constants 0 and 1 and of all classifiers, their gap and their error.

    Constants differ between no groups, so mixing one in scales the gap down to the tolerance whatever the rest is. Of the game's
    solution, each classifier alone, their mean and the weights before, that with the least error is taken.
    """
    n = len(errors)
    every = np.concatenate([constants, errors])
    rows = game.active(np.full(n, 1.0 / n) if before is None else np.append(before[2:], 0.0))
    tried = [mixture_weights(every, np.concatenate([np.zeros((len(rows), 2)), rows], axis=1), tolerance)]
    tried += [np.concatenate([[0.0, 0.0], q]) for q in [*np.eye(n), np.full(n, 1.0 / n)]]
    if before is not None:
        tried.append(np.append(before, 0.0))
    tried = [_without_traces(q) for q in tried]
    gaps = game.gaps(np.array([q[2:] for q in tried]))
    cheaper = int(np.argmin(constants))
    fair = []
    for q, gap in zip(tried, gaps, strict=True):
        if gap > tolerance:
            # within the tolerance also after rounding
            q = q * (tolerance * (1 - 1e-9) / gap)
            q[cheaper] += 1.0 - q.sum()
            gap = tolerance * (1 - 1e-9)
        fair.append((float(q @ every), q, float(gap)))
    error, q, gap = min(fair, key=lambda f: f[0])
    return q, gap, error


def _without_traces(q: np.ndarray) -> np.ndarray:
    q = np.where(q < 1e-3, 0.0, q)
    return q / q.sum()

