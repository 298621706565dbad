"""Linear models that share their passes over the data.

A problem is a penalty on one group of rows: logistic regression, squared-hinge SVM or
epsilon-insensitive regression, with half the squared norm of the weights plus C times
the weighted loss, as published.  Rows are packed once into sparse blocks that Spark
keeps (memory, then disk).  Each pass computes loss and gradient of every unfinished
problem of every group at once, on the executors, and sums them as a tree; the driver
holds weights only, whose size is features x classes x problems and not the rows'.

The solver is L-BFGS on the mean objective with a diagonal start: the second
derivatives at zero, penalty included, so that frequent and rare terms move alike
without changing the penalty.  It ends where the gradient does.
"""

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block: bounds what a task holds beside the weights.
BLOCK_ROWS = 2048
#: Largest entry of the mean objective's gradient where a fit ends.
TOLERANCE = 1e-4
MEMORY = 8
#: Widths of the rounded corners of the epsilon-insensitive loss, one fit after the other.
CORNERS = (1e-1, 1e-2, 1e-3, 1e-4)


class Block(NamedTuple):
    """Rows of a group as compressed rows."""

    group: int
    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    target: np.ndarray
    weight: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.target)), np.diff(self.starts))

    @property
    def full(self) -> bool:
        """Whether every row has every column, in order."""
        return len(self.columns) == len(self.target) * self.width

    def dot(self, w: np.ndarray) -> np.ndarray:
        """Rows times a matrix of weights; a column at a time, which numpy runs through without strides."""
        if self.full:
            return self.values.reshape(-1, self.width) @ w
        out = np.zeros((len(self.target), w.shape[1]), order="F")
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            for j, column in enumerate(np.ascontiguousarray(w.T)):
                out[some, j] = np.add.reduceat(column[self.columns] * self.values, self.starts[some])
        return out

    def back(self, residual: np.ndarray) -> np.ndarray:
        """Transposed rows times residuals."""
        if self.full:
            return self.values.reshape(-1, self.width).T @ residual
        out = np.zeros((self.width, residual.shape[1]), order="F")
        rows, columns = self.rows, self.columns.astype(np.int64)
        for j, column in enumerate(np.ascontiguousarray(residual.T)):
            out[:, j] = np.bincount(columns, column[rows] * self.values, self.width)
        return out


def columns_of(block: Block, group: int, low: int, high: int) -> Block:
    """The columns from ``low`` to before ``high`` as a block of their own."""
    keep = (block.columns >= low) & (block.columns < high)
    sizes = np.bincount(block.rows[keep], minlength=len(block.target))
    return block._replace(
        group=group, starts=np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        columns=(block.columns[keep] - low).astype(np.int32), values=block.values[keep], width=high - low)


class Loss(NamedTuple):
    """``of(scores, target, corner)`` gives each row's loss and its derivative by the scores."""

    of: Callable
    #: Second derivative at zero, by the number of scores.
    curve: Callable
    #: Scores a model of so many classes has.
    scores: Callable
    #: Whether the intercept is penalised like a weight.
    penalised: bool = False


def _logistic(z: np.ndarray, y: np.ndarray, _: float) -> tuple[np.ndarray, np.ndarray]:
    if z.shape[1] == 1:
        sign = np.where(y > 0, 1.0, -1.0)[:, None]
        margin = sign * z
        return np.logaddexp(0, -margin)[:, 0], -sign * np.exp(-np.logaddexp(0, margin))
    z = z - z.max(axis=1, keepdims=True)
    total = np.log(np.exp(z).sum(axis=1))
    rows, own = np.arange(len(y)), y.astype(int)
    slope = np.exp(z - total[:, None])
    slope[rows, own] -= 1
    return total - z[rows, own], slope


def _squared_hinge(z: np.ndarray, y: np.ndarray, _: float) -> tuple[np.ndarray, np.ndarray]:
    """One class against the rest in each score."""
    own = (y > 0)[:, None] if z.shape[1] == 1 else y.astype(int)[:, None] == np.arange(z.shape[1])
    sign = np.where(own, 1.0, -1.0)
    short = np.maximum(0, 1 - sign * z)
    return (short * short).sum(axis=1), -2 * sign * short


def _epsilon(z: np.ndarray, y: np.ndarray, corner: float, epsilon: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Absolute error beyond epsilon, quadratic over the first ``corner`` of it."""
    error = z[:, 0] - y
    beyond = np.maximum(0, np.abs(error) - epsilon)
    loss = np.where(beyond < corner, beyond * beyond / (2 * corner), beyond - corner / 2)
    return loss, (np.sign(error) * np.minimum(beyond / corner, 1))[:, None]


LOGISTIC = Loss(_logistic, lambda k: 0.25 if k == 1 else (1 / k) * (1 - 1 / k), lambda classes: 1 if classes == 2 else classes)
SQUARED_HINGE = Loss(_squared_hinge, lambda k: 2.0, lambda classes: 1 if classes == 2 else classes, True)


def epsilon_insensitive(epsilon: float = 0.0) -> Loss:
    return Loss(partial(_epsilon, epsilon=epsilon), lambda k: 1.0, lambda classes: 1, True)


class Problem(NamedTuple):
    group: int
    C: float


class Fit(NamedTuple):
    weights: np.ndarray  # scores x features
    intercept: np.ndarray
    passes: int
    gradient: float  # largest entry of the mean objective's gradient


class Stats(NamedTuple):
    n: int
    weight: float
    classes: int
    squares: np.ndarray
    total: float


def blocks(df: DataFrame, features: str = "features", label: str = "label", weight: str = "",
           group: Column | None = None) -> RDD:
    """Rows packed into blocks and kept; dense and sparse vectors may mix. Unpersist the result after use."""
    rows = df.select(
        (F.lit(0) if group is None else group).cast("int").alias("group"), F.col(features).alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("s"))
    schema = "group int, width int, starts binary, columns binary, vals binary, y binary, s binary"
    packed = rows.mapInArrow(_pack, schema).rdd.map(_block)
    return packed.persist(StorageLevel.MEMORY_AND_DISK)


def _block(row) -> Block:
    return Block(row[0], np.frombuffer(row[2], np.int64), np.frombuffer(row[3], np.int32), np.frombuffer(row[4]),
                 np.frombuffer(row[5]), np.frombuffer(row[6]), row[1])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups = batch.column("group").to_numpy()
        order = np.argsort(groups, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(groups[order])) + 1), len(order)]
        for low, high in zip(cuts, cuts[1:]):
            for at in range(low, high, BLOCK_ROWS):
                part = batch.take(pa.array(order[at:min(at + BLOCK_ROWS, high)]))
                x = part.column("x")
                dense = x.field("type").to_numpy() == 1
                sizes = x.field("values").value_lengths().to_numpy()
                values = x.field("values").flatten().to_numpy()
                width = int(sizes[0] if dense[0] else x.field("size")[0].as_py())
                if dense.all():
                    columns = np.tile(np.arange(width), len(sizes))
                elif not dense.any():
                    columns = x.field("indices").flatten().to_numpy()
                else:
                    columns = np.concatenate([np.arange(n) if d else np.array(i.as_py(), int)
                                              for d, n, i in zip(dense, sizes, x.field("indices"))])
                yield pa.RecordBatch.from_pydict({
                    "group": pa.array([groups[order[low]]], pa.int32()), "width": pa.array([width], pa.int32()),
                    **{name: pa.array([a.tobytes()], pa.binary()) for name, a in (
                        ("starts", np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)),
                        ("columns", columns.astype(np.int32)), ("vals", values.astype(float)),
                        ("y", part.column("y").to_numpy()), ("s", part.column("s").to_numpy()))}})


def _add(a: dict, b: dict) -> dict:
    """Sums tuples of arrays by key."""
    for key, parts in b.items():
        a[key] = tuple(x + y for x, y in zip(a[key], parts)) if key in a else parts
    return a


def _summed(rows: RDD, each: Callable[[Block], dict]) -> dict:
    """One pass; partial sums meet on the executors before the driver sees them."""
    def run(part: Iterator[Block]) -> Iterator[dict]:
        total: dict = {}
        for block in part:
            total = _add(total, each(block))
        yield total

    return rows.mapPartitions(run).treeReduce(_add)


def _stats(block: Block) -> dict:
    squares = np.bincount(block.columns, block.weight[block.rows] * block.values ** 2, block.width)
    top = np.zeros(4096)  # marks the classes present; more classes are no classes
    known = block.target[(block.target >= 0) & (block.target < len(top))].astype(int)
    top[known] = 1
    return {block.group: (len(block.target), block.weight.sum(), top, squares)}


def describe(rows: RDD) -> dict[int, Stats]:
    found = _summed(rows, _stats)
    return {g: Stats(int(n), float(s), int(np.flatnonzero(top).max(initial=0)) + 1, squares, float(s))
            for g, (n, s, top, squares) in found.items()}


class _Lbfgs:
    """One problem's way downhill: asks for loss and gradient at ``trial`` and is told them."""

    def __init__(self, start: np.ndarray, scale: np.ndarray, tolerance: float, passes: int):
        self.x, self.trial, self.scale, self.tolerance, self.left = start, start, scale, tolerance, passes
        self.f, self.g, self.done, self.passes = None, None, False, 0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def tell(self, f: float, g: np.ndarray) -> None:
        self.passes += 1
        if self.f is None:
            self._accept(f, g)
        elif f <= self.f + 1e-4 * self.step * self.slope + 1e-14 * abs(self.f):
            s, y = self.trial - self.x, g - self.g
            if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
                self.pairs = [*self.pairs[1 - MEMORY:], (s, y)]
            self._accept(f, g)
        else:
            # The lowest point of the parabola through what is known, within bounds.
            fall = -self.slope * self.step ** 2 / (2 * (f - self.f - self.slope * self.step))
            self.step = min(max(fall, 0.1 * self.step), 0.5 * self.step)
            self.trial = self.x + self.step * self.way
            self.done = self.step < 1e-12
        self.done |= self.passes >= self.left

    def _accept(self, f: float, g: np.ndarray) -> None:
        self.x, self.f, self.g = self.trial, f, g
        self.done = np.abs(g).max() <= self.tolerance
        q, kept = g.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            kept.append(a)
            q -= a * y
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ (y * self.scale))
        q *= self.scale
        for (s, y), a in zip(self.pairs, reversed(kept)):
            q += (a - (y @ q) / (s @ y)) * s
        self.way, self.slope = -q, -(g @ q)
        if self.slope >= 0:
            self.way, self.slope, self.pairs = -self.scale * g, -(g @ (self.scale * g)), []
        self.step = 1.0
        self.trial = self.x + self.way


def solve(rows: RDD, problems: list[Problem], loss: Loss, tolerance: float = TOLERANCE, passes: int = 1000,
          stats: dict[int, Stats] | None = None) -> list[Fit]:
    """Fits of all problems, in order. Groups differ in rows, features and classes."""
    stats = stats or describe(rows)
    context, ways = rows.context, []
    corners = CORNERS if isinstance(loss.of, partial) else (0.0,)
    shapes = [(loss.scores(max(stats[p.group].classes, 2)), len(stats[p.group].squares)) for p in problems]
    starts = [np.zeros(k * (d + 1)) for k, d in shapes]
    for corner in corners:
        ways = []
        for p, (k, d), start in zip(problems, shapes, starts):
            total, penalty = stats[p.group].total, 1 / (p.C * stats[p.group].total)
            bend = loss.curve(k) / (corner or 1.0)
            scale = np.append(bend * stats[p.group].squares / total + penalty, bend + penalty * loss.penalised)
            ways.append(_Lbfgs(start, np.tile(1 / scale, k), tolerance, passes))
        while any(not w.done for w in ways):
            asked: dict[int, list[int]] = {}
            for i, way in enumerate(ways):
                if not way.done:
                    asked.setdefault(problems[i].group, []).append(i)
            held = context.broadcast({g: (
                np.hstack([ways[i].trial.reshape(shapes[i][0], -1)[:, :-1].T for i in found]),
                np.concatenate([ways[i].trial.reshape(shapes[i][0], -1)[:, -1] for i in found]),
                [shapes[i][0] for i in found]) for g, found in asked.items()})
            sums = _summed(rows, partial(_slopes, held=held, loss=loss.of, corner=corner))
            held.destroy()
            for g, found in asked.items():
                losses, weights, intercepts = sums[g]
                at = 0
                for n, i in enumerate(found):
                    k, way = shapes[i][0], ways[i]
                    slope = np.hstack([weights[:, at:at + k].T, intercepts[at:at + k, None]]) / stats[g].total
                    at += k
                    own = way.trial.reshape(k, -1).copy()
                    own[:, -1] *= loss.penalised
                    penalty = 1 / (problems[i].C * stats[g].total)
                    way.tell(losses[n] / stats[g].total + penalty * (own * own).sum() / 2,
                             (slope + penalty * own).ravel())
        starts = [w.x for w in ways]
    return [Fit(w.x.reshape(k, -1)[:, :-1], w.x.reshape(k, -1)[:, -1], w.passes, float(np.abs(w.g).max()))
            for w, (k, _) in zip(ways, shapes)]


def _slopes(block: Block, held, loss: Callable, corner: float) -> dict:
    if block.group not in held.value:
        return {}
    w, b, sizes = held.value[block.group]
    scores, at, losses, residuals = block.dot(w) + b, 0, [], []
    for k in sizes:
        each, slope = loss(scores[:, at:at + k], block.target, corner)
        losses.append((each * block.weight).sum())
        residuals.append(slope * block.weight[:, None])
        at += k
    residual = np.hstack(residuals)
    return {block.group: (np.array(losses), block.back(residual), residual.sum(axis=0))}


def confusion(rows: RDD, fits: list[tuple[int, Fit]], classes: int) -> list[np.ndarray]:
    """Label x prediction counts of every fit on the rows of its group, all in one pass."""
    held = rows.context.broadcast([(g, f.weights.T, f.intercept) for g, f in fits])

    def each(block: Block) -> dict:
        found = {}
        for i, (group, w, b) in enumerate(held.value):
            if group == block.group:
                scores = block.dot(w) + b
                guess = (scores[:, 0] > 0).astype(int) if scores.shape[1] == 1 else scores.argmax(axis=1)
                both = block.target.astype(int) * classes + guess
                found[i] = (np.bincount(both, minlength=classes * classes),)
        return found

    sums = _summed(rows, each)
    held.destroy()
    none = (np.zeros(classes * classes, int),)
    return [sums.get(i, none)[0].reshape(classes, classes) for i in range(len(fits))]


def macro_f1(counts: np.ndarray) -> float:
    """Unweighted mean F1 of the classes that are a label or a prediction."""
    hit, actual, guessed = np.diag(counts), counts.sum(axis=1), counts.sum(axis=0)
    present = actual + guessed > 0
    return float((2 * hit[present] / (actual + guessed)[present]).mean()) if present.any() else 0.0
