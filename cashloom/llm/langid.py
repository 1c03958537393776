"""Language identification with hyperdimensional profiles.

Every letter owns a random vector of +1 and -1. A letter trigram binds its three letters'
vectors, each rotated by its place, by multiplication; a text bundles its trigrams' vectors by
addition. A language's prototype bundles all its training texts, and a document gets the
language whose prototype has the largest cosine with the document's vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import letting_go

DIMENSIONS = 1024
READY = 4096
"""Trigrams whose vectors a worker keeps ready; the others are bound when they occur."""

CHUNK = 1 << 20
"""Characters of a text that are held as numbers at once."""

BATCH = 128
"""Documents whose trigram counts are multiplied at once."""

HELD = 1 << 19
"""Trigram counts of documents that a task holds before it adds them up."""

UNKNOWN = "und"
_SPACE = 32
_BITS = 21


class _Letters:
    """Code point of the lower-case letter, or a space for what is no letter; filled as code points occur."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, -1, np.int32)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        if (found < 0).any():
            for p in np.unique(points[found < 0]).tolist():
                self.table[p] = p if chr(p).isalpha() else _SPACE
            found = self.table[points]
        return found


_letters: _Letters | None = None


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a text as numbers, and how often each occurs; none without a letter.

    Case is ignored; a run of other characters counts as one space, also at both ends.
    """
    global _letters
    if _letters is None:
        _letters = _Letters()
    codes, counts = [], []
    tail = np.array([_SPACE], np.int64)
    lower = text.lower()
    for start in range(0, len(lower) + 1, CHUNK):
        piece = lower[start : start + CHUNK]
        points = _letters(np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32))
        last = [_SPACE] if start + CHUNK > len(lower) else []
        row = np.concatenate([tail, points, last]).astype(np.int64)
        # the last two symbols so far lead on into the next piece
        space = row == _SPACE
        row = row[~(space & np.concatenate([[False], space[:-1]]))]
        if len(row) > 2:
            found = np.unique(row[:-2] << 2 * _BITS | row[1:-1] << _BITS | row[2:], return_counts=True)
            codes.append(found[0])
            counts.append(found[1])
        tail = row[-2:]
    if len(codes) == 1:
        return codes[0], counts[0]
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    distinct, at = np.unique(np.concatenate(codes), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts)).astype(np.int64)


class _Vectors:
    """Vectors of trigrams, bound from the letters' random vectors."""

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = np.random.default_rng(point).choice(np.array([-1, 1], np.int8), self.dimensions)
        return self.letters[point]

    def bind(self, codes: np.ndarray) -> np.ndarray:
        bound = np.ones((len(codes), self.dimensions), np.int8)
        for place in range(3):
            points, at = np.unique(codes >> (2 - place) * _BITS & (1 << _BITS) - 1, return_inverse=True)
            if len(points):
                bound *= np.stack([np.roll(self.letter(p), 2 - place) for p in points.tolist()])[at]
        return bound


class Profiles(NamedTuple):
    """Prototypes by language, and the trigrams to keep ready; a few hundred KB at four languages."""

    languages: list[str]
    prototypes: np.ndarray
    ready: np.ndarray


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def _labelled_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts by language, added up for each batch of documents.

    No more than about ``HELD`` counts are held at once: beyond it those of each language are
    put together, and handed on where that does not make them few.
    """
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, parts in found.items():
            codes, counts = _added(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"])
        found.clear()

    for batch in batches:
        held = 0
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            if text.as_py():
                part = trigrams(text.as_py())
                found.setdefault(lang.as_py(), []).append(part)
                held += len(part[0])
            if held > HELD:
                for name, parts in found.items():
                    found[name] = [_added(parts)]
                held = sum(len(parts[0][0]) for parts in found.values())
                if 2 * held > HELD:
                    yield from emit()
                    held = 0
        yield from emit()
        pa.default_memory_pool().release_unused()


def learn_profiles(labelled: DataFrame, *, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, ready: int = READY) -> Profiles:
    """Prototypes of the languages in ``labelled``, from all its texts; rows without text or language teach nothing.

    The driver gets one vector for each language and ``ready`` trigrams, whatever the corpus.
    """
    source = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = source.mapInArrow(letting_go(_labelled_counts), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).persist()

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _Vectors(dimensions)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, codes, n = np.asarray(batch.column(0).to_pylist(), object), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for one in set(langs.tolist()):
                at = np.flatnonzero(langs == one)
                for k in range(0, len(at), 4096):
                    part = at[k : k + 4096]
                    sums[one] = sums.get(one, 0) + n[part].astype(np.float64) @ vectors.bind(codes[part]).astype(np.float64)
        for one, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([one] * dimensions), pa.array(np.arange(dimensions)), pa.array(total)], names=["lang", "at", "x"]
            )

    parts = counts.mapInArrow(bundle, "lang string, at long, x double").groupBy("lang", "at").agg(F.sum("x").alias("x"))
    summed = parts.collect()
    common = counts.groupBy("code").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "code").limit(ready).collect()
    counts.unpersist()
    languages = sorted({r.lang for r in summed})
    prototypes = np.zeros((len(languages), dimensions), np.float32)
    for r in summed:
        prototypes[languages.index(r.lang), r["at"]] = r.x
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    prototypes /= np.where(norms > 0, norms, 1)
    return Profiles(languages, prototypes, np.sort(np.array([r.code for r in common], np.int64)))


def identify(texts: list[str | None], profiles: Profiles, vectors: _Vectors, ready: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and cosine (0 where negative) of each text. ``ready``: the vectors of ``profiles.ready``."""
    dense = np.zeros((len(texts), len(profiles.ready)), np.float32)
    documents = np.zeros((len(texts), vectors.dimensions), np.float32)
    some = np.zeros(len(texts), bool)
    for k, text in enumerate(texts):
        codes, counts = trigrams(text or "")
        some[k] = len(codes) > 0
        if len(codes) and len(profiles.ready):
            at = np.searchsorted(profiles.ready, codes)
            at[at == len(profiles.ready)] = 0
            known = profiles.ready[at] == codes
            dense[k, at[known]] = counts[known]
            codes, counts = codes[~known], counts[~known]
        for start in range(0, len(codes), 4096):
            documents[k] += counts[start : start + 4096].astype(np.float32) @ vectors.bind(codes[start : start + 4096]).astype(np.float32)
    if len(profiles.ready):
        documents += dense @ ready
    if not profiles.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    norms = np.linalg.norm(documents, axis=1, keepdims=True)
    cosines = documents @ profiles.prototypes.T / np.where(norms > 0, norms, 1)
    best = cosines.argmax(axis=1)
    score = np.clip(cosines[np.arange(len(texts)), best], 0, 1).astype(np.float64)
    return [profiles.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)], np.where(some, score, 0.0)


def predict_language(docs: DataFrame, profiles: Profiles, *, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its cosine.

    ``und`` and 0 where the text is NULL or has no letter, or where no language was learned.
    Equal cosines go to the language that comes first in the alphabet. Columns of ``docs``
    that have the names of new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in into]
    source = docs.select(*kept, F.col(text).alias("__text"))
    schema = docs.select(*kept).schema.add(into[0], "string").add(into[1], "double")
    dimensions = profiles.prototypes.shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _Vectors(dimensions)
        ready = vectors.bind(profiles.ready).astype(np.float32)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                langs, scores = identify(part.column("__text").to_pylist(), profiles, vectors, ready)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores)], names=[*kept, *into]
                )

    return source.mapInArrow(letting_go(rows), schema)
