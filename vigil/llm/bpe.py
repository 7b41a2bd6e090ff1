"""Byte-pair encoding with word ends, in batched numpy merge rounds, and its decoding.

A text is normalised and cut into words; the bytes of all new words of a batch lie in one flat array of symbols. In each round
every word merges its pair of least rank, wherever it stands in the word; ranks are found by binary search over the sorted keys
of all pairs, and only pairs beside a merge are looked up again. Words of more than ``LONG`` bytes are first cut between bytes
that no token holds side by side (no merge can cross), and what stays long goes by rank over linked symbols, so that a text
without spaces costs n log n. Both give the merges of the sequential rule: least rank first, then from the left. The vocabulary
must make no token out of a later one (checked when it is read; without this each round merges one pair of a word only).

The vocabulary file is read by the driver and broadcast: a few MB, whatever the data.

Defined results: a null text counts as empty and has no ids, an empty text decodes to an empty text; strings of special tokens
in a text become these tokens; bytes that are no UTF-8 count as U+FFFD; ids may repeat or be null; an empty table gives an empty
result; other columns are ignored. Decoding puts a space between any two tokens, whose word ends and byte signs stay, as the
vocabulary file names no decoder; a null id or one outside the vocabulary gives nothing.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from vigil.llm.common import arrow_map, documents
from vigil.llm.words import slices

VOCABULARY = "word_bpe_49k.json"
LONG = 64
PIECE = 1 << 20
CACHED_WORDS, CACHED_BYTES = 200_000, 16 << 20
_NEVER = np.int32(2**31 - 1)
# How the vocabulary writes the end of a word, and which parts of a text are words.
WORD_END = "</w>"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
_BREAK = re.compile("[ \t\n\r]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_signs() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    own = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    return [chr(b) if own[b] else chr(256 + b - sum(own[:b])) for b in range(256)]


class Vocabulary:
    """Tokens, merges as sorted pair keys, and the pairs of bytes that occur inside a token."""

    def __init__(self, content: bytes):
        file = json.loads(content)
        ids: dict[str, int] = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for text, i in (ids | self.special).items():
            self.tokens[i] = text
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
        left, right, made = (np.array([ids[t] for t in x], np.int64) for x in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        rank = np.arange(len(pairs))
        self.left, self.right, self.made = left.astype(np.int32), right.astype(np.int32), made.astype(np.int32)
        order = np.argsort(left << 32 | right)
        self.keys, self.ranks = (left << 32 | right)[order], rank[order].astype(np.int32)
        last = np.full(len(self.tokens), -1)
        np.maximum.at(last, made, rank)
        self.ordered = bool((last[left] < rank).all() and (last[right] < rank).all())
        signs = byte_signs()
        self.inner = np.array([ids[s] for s in signs], np.int32)
        self.final = np.array([ids[s + WORD_END] for s in signs], np.int32)
        byte = {ord(s): b for b, s in enumerate(signs)}
        self.together = np.zeros((256, 256), bool)
        for text in ids:
            raw = [byte[ord(c)] for c in text.removesuffix(WORD_END)]
            self.together[raw[:-1], raw[1:]] = True
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NEVER)


def _every_second(at: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of places whose pairs overlap in a run, the first, third and so on; ``follows[i]``: ``at[i + 1]`` overlaps ``at[i]``."""
    if not follows.any():
        return at
    begin = np.append(True, ~follows)
    number = np.arange(len(at))
    return at[(number - np.maximum.accumulate(np.where(begin, number, 0))) % 2 == 0]


def merge_rounds(vocabulary: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many words whose symbols lie one behind the other, and the number of ids of each word (no word is empty)."""
    word = np.arange(len(lengths))
    owner = np.repeat(word, lengths)
    ranks = np.full(len(symbols), _NEVER)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    ranks[inside] = vocabulary.pair_ranks(symbols[inside], symbols[inside + 1])
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(begins, len(symbols)))
        least = np.minimum.reduceat(ranks, begins)
        ready = least == _NEVER
        if ready.any():
            out = np.repeat(ready, sizes)
            done.append((owner[out], symbols[out]))
            symbols, owner, ranks = symbols[~out], owner[~out], ranks[~out]
            sizes, least = sizes[~ready], least[~ready]
            if not len(symbols):
                break
        at = np.flatnonzero(ranks == np.repeat(least, sizes))
        at = _every_second(at, np.diff(at) == 1)
        if not vocabulary.ordered:
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
        symbols[at] = vocabulary.made[ranks[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        at = at - np.searchsorted(at, at)  # each merge before a place moves it by one
        symbols, owner, ranks = symbols[stay], owner[stay], ranks[stay]
        beside = np.concatenate([at, at[at > 0] - 1])
        pair = beside[beside + 1 < len(symbols)]
        pair = pair[owner[pair] == owner[pair + 1]]
        ranks[beside] = _NEVER
        ranks[pair] = vocabulary.pair_ranks(symbols[pair], symbols[pair + 1])
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
    owner, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
    return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))


def merge_by_rank(vocabulary: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for long words: all places of the least rank over all words at once, ranks in rising order."""
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    n = len(symbols)
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    live = np.ones(n, bool)
    waiting: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def wait(at: np.ndarray) -> None:
        at = at[after[at] < n]
        at = at[owner[at] == owner[after[at]]]
        rank = vocabulary.pair_ranks(symbols[at], symbols[after[at]])
        known = rank != _NEVER
        at, rank = at[known].astype(np.int32), rank[known]
        if len(at) == 0:
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, group in zip(rank[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
            if r not in waiting:
                heapq.heappush(heap, r)
            waiting[r].append(group)

    step = 1 << 20
    for first in range(0, n, step):
        wait(np.arange(first, min(n, first + step), dtype=np.int32))
    while heap:
        rank = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(rank)))
        at = at[live[at] & (symbols[at] == vocabulary.left[rank]) & (after[at] < n)]
        at = at[(symbols[after[at]] == vocabulary.right[rank]) & (owner[at] == owner[after[at]])]
        if len(at) == 0:
            continue
        at = _every_second(at, after[at[:-1]] == at[1:])
        gone = after[at]
        symbols[at] = vocabulary.made[rank]
        live[gone] = False
        after[at] = after[gone]
        linked = after[at] < n
        before[after[at][linked]] = at[linked]
        wait(np.concatenate([at, before[at][before[at] >= 0]]))
    return symbols[live], np.bincount(owner[live], minlength=len(lengths))


@cache
def _unassigned() -> re.Pattern:
    """Characters on whose case and kind two versions of Unicode may differ."""
    found = [c for c in range(128, 0x110000) if unicodedata.category(chr(c)) == "Cn"]
    begins = [c for i, c in enumerate(found) if i == 0 or found[i - 1] != c - 1]
    ends = [c for i, c in enumerate(found) if i + 1 == len(found) or found[i + 1] != c + 1]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(begins, ends, strict=True)) + "]")


class Encoder:
    """Ids of texts; the ids of words met before are kept, within bounds."""

    def __init__(self, content: bytes):
        import regex

        self.vocabulary = Vocabulary(content)
        self.content = content
        self.pattern = regex.compile(WORD)
        self.library = None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.ids, self.ends, self.bytes = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def _new_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words and their number in each; a word behind a space is a special token."""
        v = self.vocabulary
        raw = [w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.array([len(r) for r in raw])
        symbols = v.inner[data]
        ends = np.cumsum(sizes)
        symbols[ends - 1] = v.final[data[ends - 1]]
        cut = np.zeros(len(data), bool)
        cut[(ends - sizes)] = True
        apart = np.flatnonzero(~v.together[data[:-1], data[1:]]) + 1
        cut[apart[np.repeat(sizes > LONG, sizes)[apart]]] = True
        begins = np.flatnonzero(cut)
        lengths = np.diff(np.append(begins, len(data)))
        part_of = np.searchsorted(ends, begins, side="right")
        far = (lengths > LONG) & v.ordered
        counts = np.zeros(len(lengths), np.int64)
        found = []
        for merge, which in ((merge_rounds, ~far), (merge_by_rank, far)):
            if which.any():
                ids, n = merge(v, symbols[np.repeat(which, lengths)], lengths[which])
                counts[which] = n
                found.append((np.repeat(np.flatnonzero(which), n), ids))
        part, ids = (np.concatenate(x) for x in zip(*found, strict=True))
        ids = ids[np.argsort(part, kind="stable")]
        per_word = np.bincount(part_of, counts, len(words)).astype(np.int64)
        special = [i for i, w in enumerate(words) if w[0] == " "]
        if special:
            starts = np.append(0, np.cumsum(per_word))
            drop = np.zeros(len(ids), bool)
            for i in special:
                drop[starts[i] + 1 : starts[i + 1]] = True
                ids[starts[i]] = v.special[words[i][1:]]
            per_word[special] = 1
            ids = ids[~drop]
        return ids, per_word

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all ``words`` in order, and the number of each word's ids."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        before = len(self.known)
        code = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if len(self.known) > before:
            fresh = list(islice(self.known, before, None))
            ids, counts = self._new_ids(fresh)
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
            self.bytes += sum(map(len, fresh))
        begin, count = self.ends[code], self.ends[code + 1] - self.ends[code]
        place = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
        out = self.ids[place]
        if len(self.known) > CACHED_WORDS or self.bytes > CACHED_BYTES:
            self.forget()
        return out, count

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text without special tokens, in lists of bounded length."""
        for piece in _pieces(text):
            if piece.isascii():
                yield _ASCII_WORD.findall(piece.lower())
            elif _unassigned().search("".join(set(piece))):
                yield self._library_words(piece)
            else:
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                if len(piece) <= 4 * PIECE:
                    yield self.pattern.findall(piece)
                else:
                    found = (m.group() for m in self.pattern.finditer(piece))
                    while part := list(islice(found, PIECE)):
                        yield part

    def _library_words(self, piece: str) -> list[str]:
        """Words by the tables of the library, for characters newer than this Python's."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_buffer(self.content)
        text = self.library.normalizer.normalize_str(piece)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts in order, and the number of each text's ids."""
        counts = np.zeros(len(texts), np.int64)
        found: list[np.ndarray] = []
        words: list[str] = []
        owners: list[int] = []
        sizes: list[int] = []

        def flush() -> None:
            ids, n = self.ids_of(words)
            np.add.at(counts, np.repeat(owners, sizes), n)
            found.append(ids)
            for waiting in (words, owners, sizes):
                waiting.clear()

        marks = self.vocabulary.marks
        for i, text in enumerate(texts):
            parts = [text or ""] if marks is None or not text or "<" not in text else marks.split(text)
            for k, part in enumerate(parts):
                for some in [[" " + part]] if k % 2 else self.words(part):
                    words += some
                    owners.append(i)
                    sizes.append(len(some))
                    if len(words) > PIECE:
                        flush()
        if words:
            flush()
        return np.concatenate(found) if found else np.zeros(0, np.int32), counts


def _pieces(text: str) -> Iterator[str]:
    """Cut a long text at white space, where neither words nor composed characters cross."""
    at = 0
    while len(text) - at > PIECE:
        gap = _BREAK.search(text, at + PIECE)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    if at < len(text):
        yield text[at:] if at else text


def strings(column: pa.Array) -> list[str | None]:
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if x is None else x.decode("utf-8", "replace") for x in column.view(pa.binary()).to_pylist()]


def _read(path: str | None) -> bytes:
    with open(path or default_path(), "rb") as file:
        return file.read()


_ENCODERS: dict[int, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(content)
    return _ENCODERS[key]


def _joined(tokens: list[str], ids: list[int]) -> str:
    return " ".join([tokens[i] for i in ids])


def encode_and_decode(df: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``id``, ``ids`` (binary: unsigned 32-bit integers, little-endian) and ``decoded``, in one pass through Python."""
    content = df.sparkSession.sparkContext.broadcast(_read(path))
    source = df.select(F.col(id).alias(id), F.col(text).cast("string").alias("__text"))
    schema = source.select(id).schema.add("ids", "binary").add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        tokens = encoder.vocabulary.tokens
        for batch in batches:
            for part in slices(batch, 1):
                flat, counts = encoder.encode(strings(part.column(1)))
                ends = np.append(0, np.cumsum(counts))
                packed = flat.astype("<u4").tobytes()
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([packed[4 * a : 4 * b] for a, b in spans], pa.binary()),
                        pa.array([_joined(tokens, flat[a:b].tolist()) for a, b in spans], pa.string()),
                    ],
                    names=schema.names,
                )

    return arrow_map(source, run, schema)


def encode(df: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``id`` and ``ids`` (array of integers) of every row."""
    content = df.sparkSession.sparkContext.broadcast(_read(path))
    source = df.select(F.col(id).alias(id), F.col(text).cast("string").alias("__text"))
    schema = source.select(id).schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in batches:
            for part in slices(batch, 1):
                flat, counts = encoder.encode(strings(part.column(1)))
                ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))], names=schema.names)

    return arrow_map(source, run, schema)


def decode(df: DataFrame, id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``id`` and ``text`` of every row of ``encode``; null ids give a null text."""
    content = df.sparkSession.sparkContext.broadcast(_read(path))
    source = df.select(F.col(id).alias(id), F.col(ids).alias("__ids"))
    schema = source.select(id).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _encoder(content.value).vocabulary.tokens
        for batch in batches:
            rows = [None if x is None else [i for i in x if i is not None and 0 <= i < len(tokens)] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if r is None else _joined(tokens, r) for r in rows], pa.string())], names=schema.names
            )

    return arrow_map(source, run, schema)


def op13_bpe(spark, folder):
    return encode_and_decode(documents(spark, folder)).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op13_bpe": op13_bpe}
ORACLE: dict[str, str] = {}
