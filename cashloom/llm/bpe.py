"""Byte-pair encoding by backtracking over longest token matches, and decoding by offsets.

An Aho-Corasick automaton over all tokens finds the longest token from a place of a word. The encoder takes the longest token, falls back to the token's
longest prefix that is a token, and steps back over the last token when nothing fits. A token
may follow another only if merging would not have joined them differently across their border;
those answers form the pair-compatibility table. The result equals that of merging by rank,
and each place of a word is given up at most once.

Text is prepared as the tokenizer file says: NFC, lower case, split into contractions, runs of
letters, single digits and runs of other characters, each word's last symbol marked as its end.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Tokenizer

from . import memory

CACHED_WORDS = 1 << 18
"""Words of one age whose ids a worker remembers, two ages in all; about 100 MB. Speed only."""

CACHED_LENGTH = 48
_END = 256

# fixed values: characters of which every version of Unicode thinks alike, in NFC as they are
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ‐-‧‰-‾€]*")
# fixed values: the pattern of the tokenizer file's split
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _class_of(kind: str) -> str:
    """The plain characters of a Unicode category, as the inside of a character class."""
    return "".join(re.escape(chr(p)) for p in range(0x20AD) if _PLAIN.fullmatch(chr(p)) and unicodedata.category(chr(p))[0] == kind)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in token strings."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """The tables of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.file = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        self.end = model["model"]["end_of_word_suffix"]
        splits = [x["pattern"].get("Regex") for x in model["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        if splits != [_SPLIT] or model["decoder"] is not None:
            raise ValueError("only word-end vocabularies with the known split and no decoder are read")

        code = {s: b for b, s in enumerate(byte_symbols())}

        def symbols(token: str) -> str:
            """One character per symbol: the byte, plus 256 for a word's last."""
            ends = token.endswith(self.end)
            body = [code[c] for c in (token[: -len(self.end)] if ends else token)]
            if ends:
                body[-1] += _END
            return "".join(map(chr, body))

        self.symbols = {i: symbols(t) for t, i in vocab.items()}
        self.lengths = {i: len(s) for i, s in self.symbols.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank_of = dict.fromkeys(self.symbols, -1)
        for r, (a, b) in enumerate(merges):
            made = vocab[a + b]
            self.rank[vocab[a] << 32 | vocab[b]] = r
            if made not in self.parts:
                self.parts[made] = (vocab[a], vocab[b])
                self.rank_of[made] = r
        # a token whose own text merges to others never comes out, so it is no match either
        reached: set[int] = set()
        for i in sorted(self.symbols, key=self.rank_of.__getitem__):
            if i not in self.parts or (reached.issuperset(self.parts[i]) and self._border(*self.parts[i], self.rank_of[i])):
                reached.add(i)
        by_symbols = {self.symbols[i]: i for i in reached}
        self.prefix: dict[int, int | None] = {}
        for i, s in self.symbols.items():
            self.prefix[i] = next((by_symbols[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in by_symbols), None)
        self.automaton = ahocorasick.Automaton()
        for s, i in by_symbols.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}

        # decoding: every token's text with a space behind it, one after the other
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        if set(names) != set(range(len(names))):
            raise ValueError("token ids must be gapless")
        texts = [(names[i] + " ").encode() for i in range(len(names))]
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.decimals = [str(i) for i in range(len(names))]

        self.ids = _Words(self)
        letters, numbers = _class_of("L"), _class_of("N")
        self.words: Callable[[str], list[str]] = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s{letters}{numbers}]+"
        ).findall
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def _border(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge across the border between two tokens comes before the one of rank ``limit``.

        Both are taken apart from the border outwards, the later merge first. A merge across the
        border of an earlier rank than what was taken apart would have come before it.
        """
        pairs, rank_of, parts = self.rank, self.rank_of, self.parts
        while True:
            if pairs.get(left << 32 | right, limit) < limit:
                return False
            l, r = rank_of[left], rank_of[right]
            if l < 0 and r < 0:
                return True
            if l > r:
                # a merge of the same rank further left comes first
                limit, left = min(limit, l), parts[left][1]
            else:
                limit, right = min(limit, r + 1), parts[right][0]

    def may_follow(self, first: int, second: int) -> bool:
        """Whether merging by rank leaves a border between these tokens when they stand side by side."""
        answer = self._border(first, second, len(self.rank) + 1)
        if len(self.compatible) > 2_000_000:
            self.compatible.clear()
        self.compatible[first << 32 | second] = answer
        return answer

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass").decode("latin-1")
        text = data[:-1] + chr(ord(data[-1]) + _END)
        size = len(text)
        found: list[int] = []
        lengths, prefix, compatible = self.lengths, self.prefix, self.compatible
        closed: set[int] = set()
        # every symbol is a token, so the leftmost-longest match from a place starts there
        longest = self.automaton.iter_long
        at, token = 0, next(longest(text))[1]
        while at < size:
            while token is not None:
                stop = at + lengths[token]
                if stop not in closed:
                    if not found:
                        break
                    fits = compatible.get(found[-1] << 32 | token)
                    if self.may_follow(found[-1], token) if fits is None else fits:
                        break
                token = prefix[token]
            if token is not None:
                found.append(token)
                at = stop
                token = next(longest(text, at))[1] if at < size else None
            else:
                # nothing leads on from here: try a shorter token before
                closed.add(at)
                last = found.pop()
                at -= lengths[last]
                token = prefix[last]
        return found

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text."""
        parts: list[bytes] = []
        at = 0
        for m in self.specials.finditer(text):
            parts += self._plain(text[at : m.start()])
            parts.append(np.int32(self.special[m[0]]).tobytes())
            at = m.end()
        parts += self._plain(text[at:] if at else text)
        return np.frombuffer(b"".join(parts), np.int32)

    def _plain(self, text: str) -> Iterator[bytes]:
        if _PLAIN.fullmatch(text):
            return map(self.ids.__getitem__, self.words(text.lower()))
        # elsewhere versions of Unicode differ: the tokenizer file's own steps split the text
        normal = self.file.normalizer.normalize_str(text)
        code = {s: b for b, s in enumerate(byte_symbols())}
        words = (bytes(code[c] for c in w).decode("utf-8") for w, _ in self.file.pre_tokenizer.pre_tokenize_str(normal))
        return map(self.ids.__getitem__, words)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the ids' token strings with a space between any two."""
        out = []
        for start in range(0, len(ids), 1 << 17):
            part = ids[start : start + (1 << 17)]
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            out.append(self.bytes[np.arange(ends[-1]) + np.repeat(self.offsets[part] - (ends - sizes), sizes)].tobytes())
        return b"".join(out)[:-1]


class _Words(dict):
    """Ids of words as int32 bytes, encoded when first asked for.

    When an age is full it becomes the old one, and the old one's words are forgotten unless
    they were asked for again.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = np.array(self.vocabulary.encode_word(word), np.int32).tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


_loaded: dict[str, Vocabulary] = {}
memory.caches.append(_loaded)


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once in each worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, *, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text; NULL and empty texts have none.

    A column of ``docs`` named like the new one is replaced.
    """
    kept = [c for c in docs.columns if c != into]
    source = docs.select(*kept, F.col(text).alias("__text"))
    schema = docs.select(*kept).schema.add(into, ArrayType(IntegerType()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            found = [vocab.encode(x.as_py() or "") for x in batch.column("__text")]
            offsets = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, into])

    return source.mapInArrow(rows, schema)


def decode_documents(docs: DataFrame, path: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of each row's token ids; NULL and empty lists give an empty text."""
    kept = [c for c in docs.columns if c != into]
    source = docs.select(*kept, F.col(ids).alias("__ids"))
    schema = docs.select(*kept).schema.add(into, "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = [x.values.to_numpy() if x.is_valid else np.empty(0, np.int32) for x in batch.column("__ids")]
            texts = pa.array([vocab.decode(x).decode() for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts], names=[*kept, into])

    return source.mapInArrow(rows, schema)


def token_digests(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids and of the decoded text of each document.

    Encoding and decoding happen in one pass, so no list of ids leaves its task.
    """
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = source.schema["__key"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            sizes, coded, decoded = [], [], []
            for x in batch.column("__text"):
                ids = vocab.encode(x.as_py() or "")
                sizes.append(len(ids))
                coded.append(sha256(" ".join(map(vocab.decimals.__getitem__, ids.tolist())).encode()).hexdigest())
                decoded.append(sha256(vocab.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), pa.array(sizes, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return source.mapInArrow(rows, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
