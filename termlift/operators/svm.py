"""One-vs-rest linear SVMs, all classes and settings trained in the same passes.

MLlib trains one class after the other, each iteration a pass of its own. Here the
rows are packed into blocks once, and a pass evaluates the loss and gradient of every
machine still in training: each block gives one partial sum for all of them, and the
partial sums are added up in SQL. The optimizer runs on the driver, on vectors of one
number per feature. It takes the steps that MLlib's takes (limited memory of 10 steps,
steps that stay in their orthant, backtracking line search), so coefficients equal MLlib's
but for rounding as long as no choice hangs on it. A feature whose slope is zero but for
rounding is such a choice: here it stays where it is, however the rows are partitioned;
MLlib moves it by chance, and on small tables the two then part in the third digit.

A fit with fewer iterations is a stage of one with more, so of settings that differ in
`maxIter` only the longest is trained.

Defined results: rows are weighted alike; features of no spread get the coefficient
zero; a class without rows gets a machine that rejects every row; an empty table raises.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVCModel, OneVsRestModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlift.operators.classify import linear_svm, one_vs_rest

# A block ends with this many non-zero entries or rows.
BLOCK_ENTRIES = 1 << 18
BLOCK_ROWS = 1 << 13
# Rows that are laid out densely at a time, and the share of non-zero entries from which that is faster.
DENSE_ROWS = 64
DENSE_SHARE = 0.02
# Partial sums of a machine are added up in this many tasks.
SLICES = 8
MEMORY = 10
TOLERANCE = 1e-6
# Slopes below this share of the steepest one are rounding.
FLAT = 1e-12

_BLOCK = "label binary, length binary, index binary, weight binary, top_label double, top_index int"
_KINDS = {"label": np.float64, "length": np.int64, "index": np.int32, "weight": np.float64}
_SUMS = "machine int, part array<double>"


@dataclass(frozen=True)
class Setting:
    """Penalty and number of iterations."""

    reg_param: float
    max_iter: int


def packed(df: DataFrame, features: str, label: str) -> DataFrame:
    """Rows as blocks: labels, entries per row, and the entries' indexes and weights one after the other, as bytes."""
    parts = F.unwrap_udt(features)
    values = F.coalesce(parts["values"], F.array().cast("array<double>"))
    index = F.coalesce(parts["indices"], F.transform(values, lambda _, place: place))
    rows = df.select(F.col(label).cast("double").alias("label"), index.alias("index"), values.alias("weight"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, entries, held = [], 0, 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            index, weight = (table[name].combine_chunks() for name in ("index", "weight"))
            columns = [table["label"].to_numpy(), np.diff(index.offsets.to_numpy()), index.flatten().to_numpy(), weight.flatten().to_numpy()]
            parts = [pa.array([column.astype(kind, copy=False).tobytes()]) for column, kind in zip(columns, _KINDS.values())]
            tops = [pa.array([columns[0].max()], pa.float64()), pa.array([columns[2].max(initial=-1)], pa.int32())]
            return pa.RecordBatch.from_arrays([*parts, *tops], [*_KINDS, "top_label", "top_index"])

        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                waiting.append(part)
                entries += len(part["index"].flatten())
                held += part.num_rows
                if entries >= BLOCK_ENTRIES or held >= BLOCK_ROWS:
                    yield block()
                    waiting, entries, held = [], 0, 0
        if waiting:
            yield block()

    return rows.mapInArrow(run, _BLOCK)


class _Block:
    def __init__(self, batch: pa.RecordBatch, row: int):
        self.label, self.length, self.index, self.weight = (np.frombuffer(batch[name][row].as_buffer(), kind) for name, kind in _KINDS.items())
        self.row = np.repeat(np.arange(len(self.label)), self.length)

    def products(self, coefficients: np.ndarray) -> np.ndarray:
        """Each row's product with every column of `coefficients`."""
        total = np.zeros((len(self.label), coefficients.shape[1]))
        some = np.flatnonzero(self.length)
        if len(some):
            first = (np.cumsum(self.length) - self.length)[some]
            total[some] = np.add.reduceat(self.weight[:, None] * coefficients[self.index], first, axis=0)
        return total

    def sums(self, of_rows: np.ndarray, size: int) -> np.ndarray:
        """For every feature, the sum of its weights times a number per row."""
        return np.bincount(self.index, self.weight * of_rows[self.row], minlength=size)

    def slopes(self, coefficients: np.ndarray, intercepts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """For every machine, a line of `coefficients`: the sums of its slope by feature, of its slope and of its loss."""
        sign = np.where(self.label[:, None] == wanted, 1.0, -1.0)
        size = coefficients.shape[1]
        if len(self.index) < DENSE_SHARE * len(self.label) * size:
            loss = np.maximum(1.0 - sign * (self.products(coefficients.T) + intercepts), 0.0)
            pull = np.where(loss > 0, -sign, 0.0)
            by_feature = np.array([self.sums(pull[:, k], size) for k in range(len(wanted))])
            return np.column_stack([by_feature, pull.sum(axis=0), loss.sum(axis=0)])
        total = np.zeros((len(wanted), size + 2))
        dense = np.zeros((min(DENSE_ROWS, len(self.label)), size))
        flat, ends = dense.ravel(), np.concatenate([[0], np.cumsum(self.length)])
        for start in range(0, len(self.label), DENSE_ROWS):
            end = min(start + DENSE_ROWS, len(self.label))
            entries = slice(ends[start], ends[end])
            places = (self.row[entries] - start) * size + self.index[entries]
            flat[places] = self.weight[entries]
            part = dense[: end - start]
            loss = np.maximum(1.0 - sign[start:end] * (part @ coefficients.T + intercepts), 0.0)
            pull = np.where(loss > 0, -sign[start:end], 0.0)
            total[:, :size] += pull.T @ part
            total[:, size] += pull.sum(axis=0)
            total[:, size + 1] += loss.sum(axis=0)
            flat[places] = 0.0
        return total


def _each_block(blocks: DataFrame, made, schema: str) -> DataFrame:
    """One row for each machine and task: the sum of what `made` gives for its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                part = made(_Block(batch, row))
                total = part if total is None else total + part
        if total is not None:
            columns = [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["machine", "part"])

    return blocks.mapInArrow(run, schema)


def _added(parts: DataFrame, machines: int) -> np.ndarray:
    """The sums of all tasks, by machine: added up in SLICES tasks per machine, whose sums the driver adds."""
    sliced = parts.withColumn("slice", F.spark_partition_id() % SLICES)

    def run(group: pa.Table) -> pa.Table:
        total = np.sum([part.values.to_numpy() for part in group["part"]], axis=0)
        return pa.table({"machine": group["machine"].slice(0, 1), "part": pa.array([total], pa.list_(pa.float64()))})

    summed = sliced.groupBy("machine", "slice").applyInArrow(run, _SUMS).toArrow()
    total = np.zeros((machines, len(summed["part"][0])))
    for machine, part in zip(summed["machine"].to_pylist(), summed["part"]):
        total[machine] += part.values.to_numpy()
    return total


def _spread_of(blocks: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The mean and the sample standard deviation of every feature, and the number of rows."""

    def made(block: _Block) -> np.ndarray:
        ones = np.ones(len(block.label))
        squares = np.bincount(block.index, block.weight * block.weight, minlength=size)
        return np.append(np.concatenate([block.sums(ones, size), squares]), len(block.label))[None, :]

    total = _added(_each_block(blocks, made, _SUMS), 1)[0]
    n = total[-1]
    mean = total[:size] / n
    variance = np.maximum(total[size:-1] - n * mean * mean, 0.0) / max(n - 1, 1)
    return mean, np.sqrt(variance), int(n)


def _direction(gradient: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """The gradient times the approximate inverse Hessian, downhill; the newest step is first."""
    direction, shares = gradient.copy(), []
    for step, change in zip(steps, changes):
        share = step @ direction / (step @ change)
        shares.append(share)
        direction -= share * change
    if steps:
        direction *= (steps[0] @ changes[0]) / (changes[0] @ changes[0])
    for step, change, share in reversed(list(zip(steps, changes, shares))):
        direction += (share - change @ direction / (step @ change)) * step
    return np.where(-direction * gradient < 0, -direction, 0.0)


class _SearchFailed(Exception):
    pass


def _line_search(at, value, gradient, direction, iteration) -> Generator:
    """The step along the direction; yields points and is sent their value and gradient."""
    orthant = np.where(at != 0, np.sign(at), np.sign(-gradient))

    def stepped(length: float) -> np.ndarray:
        point = at + direction * length
        return np.where(np.sign(point) == np.sign(orthant), point, 0.0)

    slope = gradient @ direction
    shrink = 0.1 if iteration < 1 else 0.5
    # MLlib's search always takes its first length to be too long.
    length = shrink * (0.5 / np.linalg.norm(gradient) if iteration < 1 else 1.0)
    for _ in range(20):
        point = stepped(length)
        found, found_gradient = yield point
        rise = found_gradient @ direction
        if found > value + length * slope * 1e-4:
            length *= shrink
        elif rise < 0.9 * slope:
            length *= 2.1
        elif rise > -0.9 * slope:
            length *= shrink
        else:
            return point, found, found_gradient
        if not 1e-10 <= length <= 1e10:
            break
    raise _SearchFailed


def _descent(size: int, max_iter: int) -> Generator:
    """Minimises from zero. Yields points to evaluate, is sent value and gradient, and returns the point after every iteration."""
    at = np.zeros(size)
    value, gradient = yield at
    first, values, path = abs(value), [], [at]
    steps, changes, failed, iteration = [], [], False, 0
    while iteration < max_iter:
        if np.linalg.norm(gradient) <= max(TOLERANCE * value, 1e-8):
            break
        if len(values) >= 2 and abs(value - max(values)) <= TOLERANCE * first:
            break
        try:
            if steps and steps[0] @ changes[0] < 0:
                raise _SearchFailed
            direction = _direction(gradient, steps, changes)
            point, new_value, new_gradient = yield from _line_search(at, value, gradient, direction, iteration)
        except _SearchFailed:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        steps, changes = [point - at, *steps][:MEMORY], [new_gradient - gradient, *changes][:MEMORY]
        at, value, gradient, failed = point, new_value, new_gradient, False
        values = [*values, value][-20:]
        iteration += 1
        path.append(at)
    return path


def train(blocks: DataFrame, size: int, classes: int, settings: Sequence[Setting]) -> dict[Setting, list[tuple[np.ndarray, float]]]:
    """Coefficients and intercept of every class, for each setting."""
    longest = {}
    for one in settings:
        longest[one.reg_param] = max(one.max_iter, longest.get(one.reg_param, 0))
    mean, std, n = _spread_of(blocks, size)
    inverse = np.divide(1.0, std, out=np.zeros(size), where=std > 0)
    # Features are scaled and centred, the latter by way of the intercept, so the entries stay sparse.
    centre = mean * inverse
    context = blocks.sparkSession.sparkContext
    running = {(reg, number): _descent(size + 1, most) for reg, most in longest.items() for number in range(classes)}
    points = {name: next(machine) for name, machine in running.items()}
    paths = {}
    while points:
        names = list(points)
        scaled = np.array([points[name] for name in names])
        wanted = np.array([number for _, number in names], float)
        shared = context.broadcast((scaled[:, :-1] * inverse, scaled[:, -1] - scaled[:, :-1] @ centre, wanted))

        def made(block: _Block, shared=shared) -> np.ndarray:
            return block.slopes(*shared.value)

        total = _added(_each_block(blocks, made, _SUMS), len(names)) / n
        shared.unpersist()
        for name, point, sums in zip(names, scaled, total):
            reg, weights = name[0], point[:-1]
            gradient = np.append(sums[:size] * inverse - sums[size] * centre + reg * weights, sums[size])
            gradient[np.abs(gradient) < FLAT * np.abs(gradient).max()] = 0.0
            value = sums[size + 1] + 0.5 * reg * (weights @ weights)
            try:
                points[name] = running[name].send((value, gradient))
            except StopIteration as done:
                paths[name] = done.value
                del points[name]
    found = {}
    for one in settings:
        ends = [paths[one.reg_param, number] for number in range(classes)]
        ends = [path[min(one.max_iter, len(path) - 1)] for path in ends]
        found[one] = [(end[:-1] * inverse, float(end[-1] - end[:-1] @ centre)) for end in ends]
    return found


def as_model(machines: list[tuple[np.ndarray, float]], setting: Setting, classes: int) -> OneVsRestModel:
    """MLlib's own model of these machines, which scores, is saved and is loaded as any other."""
    svm = linear_svm(setting.reg_param, setting.max_iter)
    models = []
    for coefficients, intercept in machines:
        java = LinearSVCModel._new_java_obj(
            "org.apache.spark.ml.classification.LinearSVCModel", svm.uid, Vectors.dense(coefficients), intercept
        )
        models.append(svm._copyValues(LinearSVCModel(java)))
    return one_vs_rest(svm)._copyValues(OneVsRestModel(models=models))


def fit_all(df: DataFrame, settings: Sequence[Setting], features: str = "normal", label: str = "label") -> dict[Setting, OneVsRestModel]:
    """A fitted one-vs-rest model for each setting, all trained in the same passes over `df`."""
    blocks = packed(df, features, label).persist()
    try:
        known = blocks.agg(F.max("top_label"), F.max("top_index")).first()
        if known[0] is None:
            raise ValueError("no rows to train on")
        classes, size = int(known[0]) + 1, df.select(features).first()[0].size
        trained = train(blocks, size, classes, settings)
        return {one: as_model(machines, one, classes) for one, machines in trained.items()}
    finally:
        blocks.unpersist()
