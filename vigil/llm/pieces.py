"""SentencePiece segmentation of the merge type with seeded merge-dropout, and lossless decoding.

An agenda of candidate merges is worked off by score, then from the left. Each candidate is skipped with probability
``dropout`` by a keyed hash of seed, document key, place of its left symbol and merged piece; a skipped candidate comes back
only when one of its symbols has changed. So every seed gives another segmentation, and the same one on any cluster.

No piece holds a space mark behind another character, so the agenda of each word is its own. Words of one length are worked
off together, one merge of each per round; words of more than ``LONG`` symbols take a heap each. Both give the same pieces.

A space becomes the mark, with one more in front; characters without a piece, and the mark itself, become byte pieces, so
decoding gives every text back. Defined results: null stays null, an empty text has no pieces; ids may repeat or be null (the
document key of null is a constant); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import arrow_map, documents
from vigil.llm.words import U, mixed, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20
LONG = 40
MARK = 0x2581
_NEVER = np.int32(2**31 - 1)
_SLOTS = 20
_MIX = U(0x9E3779B97F4A7C15)


class Pieces:
    """The model's pieces, and a hash table from pairs of symbols to the piece that joins them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(n)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        ids = {t: i for i, t in enumerate(text) if plain[i]}
        self.byte0 = next(i for i in range(n) if model.is_byte(i))
        singles = sorted({c for t in ids for c in t} - set(ids))  # characters that occur inside pieces only
        symbols = ids | {c: n + k for k, c in enumerate(singles)}
        self.size = n
        self.char = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.mark = self.char[MARK]
        self.char[MARK] = -1
        self.char[32] = self.mark
        _, order = np.unique(-np.array([model.get_score(i) for i in range(n)]), return_inverse=True)
        self.rank = np.append(order, np.zeros(len(singles))).astype(np.int32)
        pairs = [
            (symbols[t[:k]] << 16 | symbols[t[k:]], i)
            for t, i in ids.items()
            for k in range(1, len(t))
            if t[:k] in symbols and t[k:] in symbols
        ]
        self.keys, self.joined = np.full(1 << _SLOTS, -1, np.int64), np.full(1 << _SLOTS, -1, np.int32)
        keys, values = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.joined[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(np.arange(len(keys)), put)
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << _SLOTS) - 1)
        raw = [bytes([i - self.byte0]) if model.is_byte(i) else t.replace(chr(MARK), " ").encode() if plain[i] else b"" for i, t in enumerate(text)]
        self.lengths = np.array([len(x) for x in raw])
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(U) * _MIX) >> U(64 - _SLOTS)).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1."""
        keys = left.astype(np.int64) << 16 | right
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.joined[slot], np.int32(-1))
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << _SLOTS) - 1)
            there = self.keys[slot[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.joined[slot[open_[same]]]
            open_ = open_[~same & (there != -1)]
        return out


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Dropout:
    """Decides by a keyed hash which candidates are skipped; ``key`` has one value per document."""

    def __init__(self, rate: float, seed: int):
        self.most = U(min(int(rate * 2.0**64), 2**64 - 1))
        with np.errstate(over="ignore"):
            self.seed = mixed(np.array([seed], np.int64).view(U) * _MIX + U(1))[0]

    def skips(self, key: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        if not self.most:
            return np.zeros(len(place), bool)
        with np.errstate(over="ignore"):
            return mixed((key ^ self.seed) + (place.astype(U) << U(20) | piece.astype(U)) * _MIX) < self.most


def _candidates(model: Pieces, drop: Dropout, left, right, key, place) -> tuple[np.ndarray, np.ndarray]:
    """Piece and rank of each pair; pairs that cannot or must not be joined have the last rank."""
    piece = model.join(left, right)
    rank = np.full(len(piece), _NEVER, np.int32)
    ok = np.flatnonzero(piece >= 0)
    rank[ok] = model.rank[piece[ok]]
    if drop.most:
        rank[ok[drop.skips(key[ok], place[ok], piece[ok])]] = _NEVER
    return piece, rank


def _work_off(model: Pieces, drop: Dropout, symbols: np.ndarray, key: np.ndarray, place: np.ndarray, begin: np.ndarray, out: np.ndarray):
    """Words of one length (rows): one merge per row and round; final symbols go to ``out`` at their first character."""
    rows, width = symbols.shape
    start = np.broadcast_to(np.arange(width, dtype=np.int32), symbols.shape)
    piece, rank = _candidates(
        model, drop, symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), np.repeat(key, width - 1), (place[:, None] + start[:, :-1]).ravel()
    )
    piece, rank = piece.reshape(rows, width - 1), rank.reshape(rows, width - 1)
    while True:
        at = rank.argmin(axis=1)
        row = np.arange(len(at))
        go = rank[row, at] != _NEVER
        if not go.all():
            stay = ~go
            out[begin[stay, None] + start[stay]] = symbols[stay]
            symbols, start, piece, rank, key, place, begin, at = (x[go] for x in (symbols, start, piece, rank, key, place, begin, at))
            row = np.arange(len(at))
        if len(row) == 0:
            return
        merged = piece[row, at]
        width = symbols.shape[1] - 1
        right = np.arange(width)[None, :] > at[:, None]
        symbols = np.where(right, symbols[:, 1:], symbols[:, :-1])
        start = np.where(right, start[:, 1:], start[:, :-1])
        symbols[row, at] = merged
        if width == 1:
            out[begin[:, None] + start] = symbols
            return
        right = np.arange(width - 1)[None, :] >= at[:, None]
        piece, rank = np.where(right, piece[:, 1:], piece[:, :-1]), np.where(right, rank[:, 1:], rank[:, :-1])
        for side in (-1, 0):
            pair = at + side
            r = row[(pair >= 0) & (pair < width - 1)]
            c = pair[r]
            piece[r, c], rank[r, c] = _candidates(model, drop, symbols[r, c], symbols[r, c + 1], key[r], place[r] + start[r, c])


def _by_heap(model: Pieces, drop: Dropout, symbols: np.ndarray, key: np.ndarray, place: int, begin: int, out: np.ndarray) -> None:
    """One long word: the agenda as a heap over linked symbols."""
    n = len(symbols)
    symbol, before, after = symbols.tolist(), list(range(-1, n - 1)), [*range(1, n), -1]
    agenda: list[tuple[int, int, int, int, int]] = []
    piece, rank = _candidates(model, drop, symbols[:-1], symbols[1:], np.repeat(key, n - 1), place + np.arange(n - 1))
    for i in np.flatnonzero(rank != _NEVER).tolist():
        agenda.append((int(rank[i]), i, symbol[i], symbol[i + 1], int(piece[i])))
    heapq.heapify(agenda)
    while agenda:
        _, i, left, right, merged = heapq.heappop(agenda)
        j = after[i]
        if j < 0 or symbol[i] != left or symbol[j] != right:
            continue
        symbol[i], symbol[j], after[i] = merged, -2, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0:
                p, r = _candidates(model, drop, np.array([symbol[a]]), np.array([symbol[b]]), key, np.array([place + a]))
                if r[0] != _NEVER:
                    heapq.heappush(agenda, (int(r[0]), a, symbol[a], symbol[b], int(p[0])))
    kept = np.array(symbol)
    at = np.flatnonzero(kept != -2)
    out[begin + at] = kept[at]


def segment(texts: list[str], keys: np.ndarray, model: Pieces, drop: Dropout) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in one row, and where each text's ids end."""
    full = ["" if not t else " " + t for t in texts]
    lengths = np.array([len(t) for t in full], np.int64)
    points = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    begins = np.cumsum(lengths) - lengths
    ids = model.char[points]
    mark, unknown = ids == model.mark, ids < 0
    cut = unknown.copy()
    cut[1:] |= unknown[:-1] | (mark[1:] & ~mark[:-1])
    cut[begins[lengths > 0]] = True
    word = np.flatnonzero(cut)
    size = np.diff(np.append(word, n))
    text = np.searchsorted(begins, word, side="right") - 1  # empty texts begin where the next one does
    place = word - begins[text]
    key = keys[text]
    out = np.full(n, -2, np.int32)
    alone = word[size == 1]
    out[alone] = ids[alone]
    order = np.argsort(size, kind="stable")
    for length in np.unique(size).tolist():
        if length == 1:
            continue
        a, b = np.searchsorted(size, length, sorter=order), np.searchsorted(size, length, side="right", sorter=order)
        if length > LONG:
            for i in order[a:b].tolist():
                _by_heap(model, drop, ids[word[i] : word[i] + length], key[i : i + 1], int(place[i]), int(word[i]), out)
            continue
        for at in range(a, b, 8192):
            i = order[at : min(at + 8192, b)]
            _work_off(model, drop, ids[word[i][:, None] + np.arange(length)], key[i], place[i], word[i], out)
    ends = np.cumsum(lengths)
    lost = np.flatnonzero((out == -1) | (out >= model.size))  # no piece of their own: their bytes instead
    if len(lost):
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in points[lost].tolist()]
        wide = np.ones(n, np.int64)
        wide[out == -2] = 0
        wide[lost] = [len(x) for x in raw]
        total = np.concatenate([[0], np.cumsum(wide)])
        final = np.repeat(out, wide)
        spread = np.arange(int(wide[lost].sum())) + np.repeat(total[lost] - (np.cumsum(wide[lost]) - wide[lost]), wide[lost])
        final[spread] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + model.byte0
        return final, total[ends]
    kept = out != -2
    return out[kept], np.concatenate([[0], np.cumsum(kept)])[ends]


def text_of(ids: np.ndarray, ends: np.ndarray, model: Pieces) -> list[bytes]:
    """The UTF-8 bytes of each row of ids, without the space in front."""
    lengths = model.lengths[ids]
    total = np.concatenate([[0], np.cumsum(lengths)])
    place = np.arange(total[-1]) + np.repeat(model.begins[ids] - total[:-1], lengths)
    raw = model.bytes[place].tobytes()
    cuts = total[np.concatenate([[0], ends])].tolist()
    return [raw[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


Batches = Iterator[pa.RecordBatch]


def _encoded(batches: Batches, model: str, dropout: float, seed: int) -> Batches:
    known, drop = pieces(model), Dropout(dropout, seed)
    for whole in batches:
        for batch in slices(whole, 1, 1 << 20):
            texts = batch.column(1)
            ids, ends = segment(texts.to_pylist(), np.asarray(batch.column(2)).view(U), known, drop)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids, pa.int32()), mask=texts.is_null()
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "pieces"])


def _decoded(batches: Batches, model: str) -> Batches:
    known = pieces(model)
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            lists = batch.column(1)
            ids = np.asarray(lists.flatten())
            ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)), dtype=np.int64)
            texts = [x.decode("utf-8", "surrogatepass") for x in text_of(ids, ends, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(texts, pa.string(), mask=np.asarray(lists.is_null()))], names=["id", "pieces", "text"]
            )


def _keyed(df: DataFrame, id: str, text: str) -> tuple[DataFrame, str]:
    source = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(id)).alias("key"))
    return source, source.schema["id"].dataType.simpleString()


def encode(
    df: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED
) -> DataFrame:
    """One row per input row: id and ``pieces``, the ids of the text's pieces."""
    source, kind = _keyed(df, id, text)
    found = arrow_map(source, lambda b: _encoded(b, model, dropout, seed), f"id {kind}, pieces array<int>")
    return found.withColumnRenamed("id", id)


def decode(df: DataFrame, id: str = "doc_id", column: str = "pieces", model: str = MODEL) -> DataFrame:
    """One row per input row: id, ``pieces`` and ``text``, which the pieces stand for."""
    source = df.select(F.col(id).alias("id"), F.col(column).alias("pieces"))
    kind = source.schema["id"].dataType.simpleString()
    found = arrow_map(source, lambda b: _decoded(b, model), f"id {kind}, pieces array<int>, text string")
    return found.withColumnRenamed("id", id)


def encode_and_decode(
    df: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED
) -> DataFrame:
    """``decode(encode(df))`` in one pass over the rows: half the Python processes."""
    source, kind = _keyed(df, id, text)
    found = arrow_map(
        source, lambda b: _decoded(_encoded(b, model, dropout, seed), model), f"id {kind}, pieces array<int>, text string"
    )
    return found.withColumnRenamed("id", id)


def op9_sentencepiece(spark, folder):
    back = encode_and_decode(documents(spark, folder))
    return back.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(" ", F.col("pieces").cast("array<string>")), 256).alias("pieces_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"),
    )


QUERIES = {"op9_sentencepiece": op9_sentencepiece}
ORACLE = {}
