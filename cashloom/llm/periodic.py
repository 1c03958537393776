"""Periodic runs: stretches of words that repeat with a period at least four times over.

A run is a stretch with smallest period q and at least ``max(6, 4 q)`` words that no
neighbouring word extends with the same period. Runs are found by seed and extension on the
diagonals of a text against itself (positions i and i + q):

* Lags are taken in levels, 2^j to 2^(j+1) - 1. The words of a run with such a period match
  their successors q words on over at least ``3 * 2^j`` places (five for q = 1): the minimum
  guaranteed overlap, which is the length of the level's k-grams.
* The k-grams of a level are indexed and each occurrence is paired with the next one in the same
  document. The next is enough: k is at least q, so if the first k-gram of a run came again after
  d < q words, these k + d words inside the run would have the periods d and q, and the run a
  smaller one. For the same reason a pair's lag is the smallest period of the stretch it spans.
* Pairs are extended in both directions as long as words match. A table with the place that each
  lag has been covered up to suppresses pairs on a stretch that was extended before, so a lag
  never reads a place twice.

k-grams are told apart exactly, by numbers: one of 2^m words is the pair of its halves' numbers,
any other length the pair of two overlapping ones. A place whose gram does not come again in its
document is dropped from the longer grams.

Documents of a batch are worked on together, with a word of its own between two, so no gram or
match reaches from one into the next.

Defined results: NULL and empty texts have no words and no runs, and their collapsed text is
empty. Ids play no part, so repeated rows and NULL ids are rows like any other.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 6
"""Words of the shortest run."""

TIMES = 4
"""How often a run holds its period."""

BLOCK_WORDS = 1 << 17
"""Words of several documents that are searched together; a longer document is a block of its own."""

Run = tuple[int, int, int]
"""First word, words and period."""


class _Grams:
    """Numbers of the grams of 2^m words, for the places where they may come again."""

    def __init__(self, words: np.ndarray, document: np.ndarray) -> None:
        self.document = document
        self.size = len(words)
        self.power = 0
        self.names = words  # by place; -1 where a gram is known not to come again
        self.drop_single()

    def drop_single(self) -> None:
        """Forget grams that occur once in their document."""
        at = np.flatnonzero(self.names >= 0)
        if not len(at):
            return
        order = at[np.lexsort((at, self.names[at], self.document[at]))]
        name, doc = self.names[order], self.document[order]
        same = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
        single = ~(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
        self.names[order[single]] = -1

    def pairs(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose gram and the one ``shift`` words on are both known, and a number for the two."""
        if shift >= self.size:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero((self.names[:-shift] >= 0) & (self.names[shift:] >= 0))
        return at, self.names[at] * (self.names.max(initial=0) + 1) + self.names[at + shift]

    def double(self) -> None:
        """From grams of 2^m words to grams of 2^(m+1)."""
        at, both = self.pairs(1 << self.power)
        names = np.full(self.size, -1, np.int64)
        names[at] = np.unique(both, return_inverse=True)[1]
        self.names = names
        self.power += 1
        self.drop_single()


def _seeds(place: np.ndarray, name: np.ndarray, document: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of a gram whose next one in the document comes ``low`` to ``high`` words later, and that lag."""
    order = np.lexsort((place, name, document[place]))
    place, name = place[order], name[order]
    lag = place[1:] - place[:-1]
    same = (name[1:] == name[:-1]) & (document[place[1:]] == document[place[:-1]]) & (low <= lag) & (lag <= high)
    return place[:-1][same], lag[same]


def _matching(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, going by ``step``, hold the word found ``lag`` words later."""
    found, span = 0, 16
    limit = at + 1 if step < 0 else len(words) - lag - at
    while found < limit:
        n = min(span, limit - found)
        if step > 0:
            unlike = words[at + found : at + found + n] != words[at + found + lag : at + found + lag + n]
        else:
            end = at - found + 1
            unlike = (words[end - n : end] != words[end - n + lag : end + lag])[::-1]
        stop = int(unlike.argmax()) if unlike.any() else n
        found += stop
        if stop < n:
            break
        span *= 2
    return found


def block_runs(words: np.ndarray, document: np.ndarray, longest: int) -> list[Run]:
    """Runs of a block. ``words`` are numbers, unique ones between documents; ``longest``: words of the longest document."""
    found: list[Run] = []
    if longest < LEAST:
        return found
    grams = _Grams(words.copy(), document)
    reach: dict[int, int] = {}

    def extend(place: np.ndarray, lag: np.ndarray) -> None:
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # neighbouring seeds of one lag lie on the same stretch
        first = np.ones(len(place), bool)
        first[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        for at, q in zip(place[first].tolist(), lag[first].tolist(), strict=True):
            covered = reach.get(q, -1)
            if at < covered:
                continue
            left = at - _matching(words, at - 1, q, -1) if at else 0
            right = at + _matching(words, at, q, 1)
            reach[q] = right
            if right - left + q >= max(LEAST, TIMES * q):
                found.append((left, right - left + q, q))

    for level in range(longest.bit_length()):
        if TIMES << level > longest:
            break
        # of 2^(level+1) words, but four for the first two levels: k is five, six, 12, 24 ...
        while grams.power < max(2, level + 1):
            grams.double()
        if not (grams.names >= 0).any():
            break
        extend(*_seeds(*grams.pairs(1 << level), document, 1 << level, (2 << level) - 1))
    return found


def _split(text: str | None) -> list[bytes]:
    """Words between the six ASCII white-space characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def text_runs(texts: Sequence[list[bytes]]) -> list[list[Run]]:
    """The runs of each list of words, by start and period."""
    result: list[list[Run]] = [[] for _ in texts]
    queue: list[int] = []
    waiting = 0

    def search() -> None:
        fresh = count()
        table: defaultdict[bytes, int] = defaultdict(fresh.__next__)
        numbers: list[int] = []
        for k in queue:
            numbers += [table[w] for w in texts[k]]
            numbers.append(next(fresh))
        sizes = np.array([len(texts[k]) + 1 for k in queue])
        document = np.repeat(np.arange(len(queue)), sizes)
        offset = np.cumsum(sizes) - sizes
        for start, length, period in block_runs(np.array(numbers, np.int64), document, int(sizes.max()) - 1):
            own = document[start]
            result[queue[own]].append((start - int(offset[own]), length, period))

    for k, words in enumerate(texts):
        if len(words) < LEAST:
            continue
        queue.append(k)
        waiting += len(words)
        if waiting >= BLOCK_WORDS:
            search()
            queue, waiting = [], 0
    if queue:
        search()
    for runs in result:
        runs.sort(key=lambda r: (r[0], r[2]))
    return result


def collapse(words: list[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those that lie in a run behind its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, *, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with runs, collapsed and n_words.

    ``runs`` lists start, length and period of every run by start and period, in words of the
    whole text; ``collapsed`` has the words that no run repeats, joined by single spaces. Columns
    of ``docs`` with these names are replaced.
    """
    made = ("runs", "collapsed", "n_words")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    source = docs.select(*kept, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("__text").schema)
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_split(x) for x in batch.column(len(kept)).to_pylist()]
            runs = text_runs(texts)
            sizes = np.cumsum([0, *map(len, runs)])
            flat = np.array([r for one in runs for r in one], np.int64).reshape(-1, 3)
            listed = pa.ListArray.from_arrays(
                pa.array(sizes, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(item))
            )
            collapsed = pa.array([b" ".join(collapse(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(texts, runs, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], listed, collapsed, pa.array([len(w) for w in texts], pa.int64())], names=[*kept, *made]
            )

    return source.mapInArrow(rows, ", ".join(filter(None, [kinds, f"runs {RUNS}", "collapsed string", "n_words bigint"])))
