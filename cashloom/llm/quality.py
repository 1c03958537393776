"""Quality classifier learned from preference pairs.

A Bradley-Terry model gives each document a strength that is linear in its features; of two
labelled documents, the better one wins with the logistic of the difference of strengths. The
decision threshold is a quantile of the strengths of all labelled documents, and scores are spread
around it so that it lies at a stated value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..sources.staging import Staging
from .memory import letting_go
from .ngram import BROADCAST_IDS

BINS = 32
"""Bins of a unit of strength in which the preferences of labelled documents are added up."""

REACH = 16
"""Strengths beyond this, either way, share the last bins of a fit."""

CUTS = 1 << 16
"""Places of a strength where the threshold may lie; the closer together, the nearer to 0."""

STEPS = 25
"""Newton steps of a fit, at most; a pass over the labelled documents' features each."""

DECISION = 0.3
"""Score of the threshold."""

FEATURES = (
    "space", "lower", "upper", "digit", "symbol", "stop", "bang", "word_length", "short_words", "adjacent_repeats",
    "distinct_words", "repeated_lines", "log_words", "shouted",
)
WIDTH = len(FEATURES)

_CLASSES: np.ndarray | None = None


def _classes() -> np.ndarray:
    """Class of each code point: 0 space, 1 lower, 2 upper, 3 digit, 4 symbol, 5 stop, 6 bang."""
    global _CLASSES
    if _CLASSES is None:
        table = np.full(0x110000, 4, np.uint8)
        for p in range(0x3000):
            c = chr(p)
            table[p] = 0 if c.isspace() else 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 5 if c in ".,;:'\"-()?" else 6 if c == "!" else 4
        table[0x3000:0xE000] = 1  # scripts without case
        table[0xF900:0xFB00] = 1
        _CLASSES = table
    return _CLASSES


def features(text: str | None) -> np.ndarray:
    """Shares and means that tell prose from junk; all zero for a text without a word."""
    words = text.split() if text else []
    if not words:
        return np.zeros(len(FEATURES))
    table, counts = _classes(), np.zeros(7)
    for start in range(0, len(text), 1 << 20):
        points = np.frombuffer(text[start : start + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        counts += np.bincount(table[points], minlength=7)
    n, m, size = len(text), len(words), n_chars(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    return np.array(
        [
            *(counts / n),
            min(size / m, 40) / 10,
            sum(len(w) < 4 for w in words) / m,
            sum(map(str.__eq__, words, words[1:])) / m,
            len(set(words)) / m,
            1 - len(set(lines)) / max(len(lines), 1),
            np.log1p(m) / 10,
            counts[2] / max(counts[1] + counts[2], 1),
        ]
    )


def n_chars(words: list[str]) -> int:
    return sum(map(len, words))


class Ranker(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) / self.scale @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the threshold lies at :data:`DECISION`, and texts without a word at 0."""
        at = (self.strength(rows) - self.threshold) / self.spread + np.log(DECISION / (1 - DECISION))
        return np.where(rows.any(axis=1), 1 / (1 + np.exp(-np.clip(at, -40, 40))), 0.0)


def _sums(learned: DataFrame, cells: int, cell: Callable[[np.ndarray, np.ndarray], np.ndarray], values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``values`` of all rows of ``learned`` (label, x) added up by ``cell``, which tells their place from labels and x.

    Tasks add up their rows, and a shuffle of the cells the tasks' sums; only ``cells`` sums reach
    the driver. They are added in the order of the tasks, so that a run again gives the same.
    """

    def reduced(at: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(at, kind="stable")
        found, first = np.unique(at[order], return_index=True)
        return found, np.add.reduceat(sums[order], first, axis=0)

    def as_table(found: np.ndarray, sums: np.ndarray, task: int) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(np.full(len(found), task), pa.int32()), lists], names=["cell", "task", "sums"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
                found, sums = reduced(cell(batch.column("label").to_numpy(), x), values(x))
                if total is None:
                    total, seen = np.zeros((cells, sums.shape[1])), np.zeros(cells, bool)
                total[found] += sums
                seen[found] = True
        if total is not None:
            yield as_table(np.flatnonzero(seen), total[seen], TaskContext.get().partitionId())

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cell", "ascending"), ("task", "ascending")]).combine_chunks()
        sums = table.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return pa.Table.from_batches([as_table(*reduced(table.column("cell").to_numpy(), sums), 0)])

    schema = "cell int, task int, sums array<double>"
    merged = learned.mapInArrow(letting_go(rows), schema).groupBy(F.col("cell") % 16).applyInArrow(merge, schema).toArrow()
    if not merged.num_rows:
        return np.zeros((cells, 0))
    sums = merged.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(merged.num_rows, -1)
    out = np.zeros((cells, sums.shape[1]))
    out[merged.column("cell").to_numpy()] = sums
    return out


def fit_preferences(learned: DataFrame, *, ridge: float = 1e-2) -> Ranker:
    """Fit strengths on every preference of a document of label 1 over one of label 0; ``learned`` (label, x) is a stored table.

    Newton steps on the logistic loss of all pairs: documents are added up in narrow bins of
    their strength, and the pairs between two bins have the loss of the bins' means. With one label
    only there are no preferences and all texts with words are alike: below :data:`DECISION` if the
    label is 0, at it if it is 1 or there is none.
    """
    first = _sums(learned, 2, lambda label, x: label, lambda x: np.hstack([np.ones((len(x), 1)), x]))
    bad, good = first[:, 0] if first.size else (0, 0)
    if not good or not bad:
        return Ranker(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), float(bad > 0), 1.0)
    mean = first[:, 1:].sum(axis=0) / (good + bad)
    scale = np.sqrt(_sums(learned, 1, lambda label, x: np.zeros(len(x), int), lambda x: (x - mean) ** 2)[0] / (good + bad))
    scale[scale < 1e-9] = 1.0

    def products(x: np.ndarray) -> np.ndarray:
        unit = (x - mean) / scale
        return np.hstack([np.ones((len(x), 1)), unit, (unit[:, :, None] * unit[:, None, :]).reshape(len(x), -1)])

    weights, bins = np.zeros(WIDTH), 2 * REACH * BINS
    for _ in range(STEPS):

        def in_bins(label: np.ndarray, x: np.ndarray, weights: np.ndarray = weights) -> np.ndarray:
            strength = (x - mean) / scale @ weights
            return label * bins + np.clip((strength + REACH) * BINS, 0, bins - 1).astype(int)

        found = _sums(learned, 2 * bins, in_bins, products).reshape(2, bins, -1)
        (n0, x0, xx0), (n1, x1, xx1) = [(side[:, 0], side[:, 1 : WIDTH + 1], side[:, WIDTH + 1 :]) for side in (s[s[:, 0] > 0] for s in found)]
        gap = (x1 / n1[:, None] @ weights)[:, None] - (x0 / n0[:, None] @ weights)[None, :]
        p = 1 / (1 + np.exp(-np.clip(gap, -30, 30)))
        pull, bend = 1 - p, p * (1 - p)
        gradient = (x0.T @ (n1 @ pull) - x1.T @ (pull @ n0)) / (good * bad) + ridge * weights
        cross = x1.T @ bend @ x0
        square = ((bend @ n0) @ xx1 + (n1 @ bend) @ xx0).reshape(WIDTH, WIDTH)
        step = np.linalg.solve((square - cross - cross.T) / (good * bad) + ridge * np.eye(WIDTH), gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-4:
            break

    def places(label: np.ndarray, x: np.ndarray) -> np.ndarray:
        strength = (x - mean) / scale @ weights
        return label * CUTS + np.minimum(CUTS / (1 + np.exp(-np.clip(strength / 4, -40, 40))), CUTS - 1).astype(int)

    low, high = _sums(learned, 2 * CUTS, places, lambda x: np.ones((len(x), 1))).reshape(2, CUTS)
    at = (np.arange(CUTS) + 1e-9) / CUTS
    edges = 4 * np.log(at / (1 - at))
    below_low, below_high = np.cumsum(low) - low, np.cumsum(high) - high
    # the cut that leaves as many labelled documents below it as are of label 0, or the one
    # nearby that parts the labels best
    held = np.flatnonzero(low + high)
    cuts = np.arange(held[0], held[-1] + 1)
    off = np.abs((below_low + below_high)[cuts] / (good + bad) - bad / (good + bad))
    cuts, off = cuts[off <= max(0.1, off.min())], off[off <= max(0.1, off.min())]
    wrong = below_high[cuts] + bad - below_low[cuts]
    same = edges[cuts[wrong == wrong.min()]]
    threshold = float((same.min() + same.max()) / 2)
    middle = [edges[np.searchsorted(np.cumsum(side), side.sum() / 2)] for side in (low, high)]
    return Ranker(mean, scale, weights, threshold, max(float(middle[1] - middle[0]) / 8, 1e-6))


def learn_ranker(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality") -> Ranker:
    """Fit on all labelled documents; rows without id, text or label teach nothing.

    Features of the labelled documents are stored while the fit reads them; only sums reach the driver.
    """
    # equal rows are one label; an id with both labels teaches nothing
    one = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("__id"))
        .agg(F.min(label).alias("__label"), F.max(label).alias("__most"))
        .where(F.col("__label") == F.col("__most"))
        .select("__id", F.col("__label").cast("int").alias("__label"))
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x.as_py()).tolist() for x in batch.column("__text")]
            kept = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, pa.list_(pa.float64()))], names=[*kept, "x"])

    def read(frame: DataFrame) -> DataFrame:
        return frame.mapInArrow(letting_go(rows), frame.drop("__text").schema.add("x", ArrayType(DoubleType())))

    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    with Staging(docs.sparkSession) as stage:
        one = stage(one)
        # few labels pick their texts out; many meet the features, which are far smaller than texts
        if one.count() <= BROADCAST_IDS:
            joined = read(texts.join(F.broadcast(one), "__id").select("__id", "__label", "__text"))
        else:
            joined = read(texts).join(one, "__id")
        # repeated documents count once
        single = joined.groupBy("__id").agg(F.min(F.struct(F.col("__label").alias("label"), "x")).alias("r"))
        return fit_preferences(stage(single.select("r.label", "r.x")))


def score_quality(docs: DataFrame, ranker: Ranker, *, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; a column of that name is replaced. No word, NULL included: 0."""
    kept = [c for c in docs.columns if c != into]
    source = docs.select(*kept, F.col(text).alias("__text"))
    schema = docs.select(*kept).schema.add(into, "double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = np.array([features(x.as_py()) for x in batch.column("__text")])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(ranker.score(matrix))], names=[*kept, into])

    return source.mapInArrow(letting_go(rows), schema)
