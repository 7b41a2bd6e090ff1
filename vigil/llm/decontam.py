"""Benchmark passages in documents by the q-gram lemma and banded alignment.

A passage within ``k`` edits of an item of ``m`` characters shares at least ``m - q + 1 - k * q`` q-grams with it, all on
``k + 1`` neighbouring diagonals (place in the document minus place in the item). So q-grams that a document shares with
an item are counted in overlapping diagonal bands; bands that meet the bound are kept and verified by an alignment inside
the band. The budget ``k`` is 5 % of the item's length, less where the lemma would have no force.

Memory in a task is bounded, however often a q-gram occurs: places of the text are taken in order, ``MOST_HITS`` pairs of
place and item at a time, and a band is decided as soon as no later place can reach it. Alignments are batched by cells.

Items reach the tasks in blocks of a bounded size (``BLOCK_CHARS`` characters, at least one item); a larger benchmark means
more passes over the documents. Documents are not shuffled.

Texts are compared in lower case, each run of characters that are neither letters nor digits as one space. Defined results:
null or empty texts and items match nothing, nor do items of fewer than ``q`` such characters; ids may repeat or be null;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigil.llm.common import arrow_map, documents
from vigil.llm.words import U, keyed, mixed, slices, window_hashes

GRAM = 12
PERCENT = 5
BLOCK_CHARS = 2_000_000
SLICE_BYTES = 1 << 20  # of text at a time: a search takes about 75 bytes of scratch memory per byte
MOST_HITS = 1 << 18
MOST_CELLS = 1 << 21
_BITS = 23
_POINT = keyed(1, 301)[0]

_LOWER = np.arange(1 << 16, dtype=np.uint32)
_WORD = np.zeros((1 << 16) + 1, bool)
for _i in range(1 << 16):
    _c = chr(_i)
    _WORD[_i] = _c.isalnum()
    _l = _c.lower()
    if len(_l) == 1 and ord(_l) < 1 << 16:
        _LOWER[_i] = ord(_l)
_WORD[1 << 16] = True  # all beyond counts as letters
_END = 0x110000  # between texts; never a character


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one row of code points, each followed by one mark; the text and the place in it of each; text begins."""
    raw = [t or "" for t in texts]
    lengths = np.array([len(t) for t in raw], np.int64) + 1
    points = np.frombuffer("\0".join([*raw, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum(lengths) - lengths
    final = np.zeros(len(points), bool)
    final[begins + lengths - 1] = True
    low = points < 1 << 16
    points = np.where(low, _LOWER[np.where(low, points, 0)], points)
    word = _WORD[np.minimum(points, 1 << 16)] & ~final
    after = np.zeros(len(points), bool)
    after[1:] = word[:-1]
    keep = word | after | final  # the first separator after a word, and the mark
    place = np.flatnonzero(keep)
    out = np.where(final[place], _END, np.where(word[place], points[place], 32)).astype(np.uint32)
    owner = np.repeat(np.arange(len(raw)), np.add.reduceat(keep, begins)) if len(raw) else np.zeros(0, int)
    return out, owner, place - begins[owner], np.searchsorted(owner, np.arange(len(raw) + 1))


def _gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return window_hashes(mixed(points.astype(U) + _POINT), q)


@dataclass(frozen=True)
class Index:
    """The items of one block: code points, edit budgets, bounds and band widths, and their q-grams in order of hash."""

    q: int
    ids: list
    texts: list[np.ndarray]
    budget: np.ndarray
    bound: np.ndarray
    width: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str | None], q: int, percent: int) -> Index:
        points, _, _, begins = normalised(texts)
        kept, cut, hashes, item, at = [], [], [], [], []
        for i, (a, b) in enumerate(zip(begins[:-1], begins[1:], strict=True)):
            own = points[a : b - 1]
            own = own[:-1] if len(own) and own[-1] == 32 else own
            if len(own) >= q:
                h = _gram_hashes(own, q)
                hashes.append(h)
                item.append(np.full(len(h), len(kept)))
                at.append(np.arange(len(h)))
                kept.append(ids[i])
                cut.append(own)
        m = np.array([len(x) for x in cut], np.int64)
        budget = np.maximum(0, np.minimum(m * percent // 100, (m - q) // q))
        joined = [np.concatenate(x) if x else np.zeros(0, k) for x, k in ((hashes, U), (item, np.int64), (at, np.int64))]
        order = np.argsort(joined[0], kind="stable")
        grams, first = np.unique(joined[0][order], return_index=True)
        return cls(q, kept, cut, budget, m - q + 1 - budget * q, budget + 1, grams, np.append(first, len(order)), joined[1][order], joined[2][order])

    def present(self) -> np.ndarray:
        out = np.zeros(1 << _BITS, bool)
        out[(self.grams >> U(64 - _BITS)).astype(np.int64)] = True
        return out


def _bands(points: np.ndarray, index: Index, present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Item and first diagonal of every band with enough shared q-grams."""
    hashes = _gram_hashes(points, index.q)
    place = np.flatnonzero(present[(hashes >> U(64 - _BITS)).astype(np.int64)])
    slot = np.searchsorted(index.grams, hashes[place])
    slot[slot == len(index.grams)] = 0
    same = index.grams[slot] == hashes[place]
    place, slot = place[same], slot[same]
    items = len(index.ids)
    lengths = index.bound - 1 + index.q + index.budget * index.q
    ends = np.cumsum(index.first[slot + 1] - index.first[slot])
    none = np.zeros(0, np.int64)
    open_keys, open_counts, held, at = none, none, [none], 0
    while at < len(place):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + MOST_HITS, side="right")))
        s = slot[at:to]
        n = index.first[s + 1] - index.first[s]
        own = np.arange(int(n.sum())) + np.repeat(index.first[s] - (np.cumsum(n) - n), n)
        item = index.item[own]
        band = (np.repeat(place[at:to], n) - index.at[own]) // index.width[item]
        hit = (band + 2) * items + item  # each hit lies in two bands
        keys, counts = np.unique(np.concatenate([hit, hit - items]), return_counts=True)
        keys, slots = np.unique(np.concatenate([open_keys, keys]), return_inverse=True)
        counts = np.bincount(slots, np.concatenate([open_counts, counts]), len(keys)).astype(np.int64)
        item = keys % items
        last = (keys // items) * index.width[item] + lengths[item]  # no place from here on lies in the band
        closed = last <= place[to] if to < len(place) else np.ones(len(keys), bool)
        held.append(keys[closed & (counts >= index.bound[item])])
        open_keys, open_counts, at = keys[~closed], counts[~closed], to
    keys = np.sort(np.concatenate(held))
    item = keys % items if items else keys
    return item, (keys // max(1, items) - 2) * index.width[item]


def _batches(item: np.ndarray, index: Index) -> Iterator[np.ndarray]:
    """Places in ``item`` whose alignments are made together: items of similar length, a bounded number of cells."""
    lengths = np.array([len(index.texts[k]) for k in item], np.int64)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        cells = np.arange(1, min(2048, len(order) - at) + 1) * lengths[order[at : at + 2048]]
        to = at + max(1, int(np.searchsorted(cells, MOST_CELLS, side="right")))
        yield order[at:to]
        at = to


def _align(patterns: list[np.ndarray], points: np.ndarray, diagonal: np.ndarray, across: np.ndarray, ended: bool = False):
    """Least edits of each pattern against ``points``, over diagonals ``diagonal`` to ``diagonal + across - 1``.

    The passage may begin and end anywhere in the band; with ``ended`` it begins where the first diagonal does. Gives the
    edits and the place in ``points`` just behind the passage.
    """
    n, most = len(patterns), int(across.max())
    lengths = np.array([len(p) for p in patterns])
    shift = np.arange(most)
    far = np.int32(1 << 20)
    outside = shift[None, :] >= across[:, None]
    row = np.where(outside, far, 0).astype(np.int32)
    if ended:
        row = np.where(outside, far, np.abs(shift[None, :] - (across[:, None] // 2))).astype(np.int32)
        row[shift[None, :] < across[:, None] // 2] = far
    pattern = np.full((n, int(lengths.max())), -1, np.int32)
    for i, p in enumerate(patterns):
        pattern[i, : len(p)] = p
    best, end = np.full(n, far), np.zeros(n, np.int64)
    for j in range(pattern.shape[1]):
        place = diagonal[:, None] + j + shift[None, :]
        inside = (place >= 0) & (place < len(points))
        here = points[np.clip(place, 0, len(points) - 1)].astype(np.int32)
        step = row + ((here != pattern[:, j, None]) | ~inside | (here == _END))
        skip = np.full_like(row, far)
        skip[:, :-1] = row[:, 1:] + 1  # the item's character has no partner
        step = np.minimum(step, skip)
        step = np.minimum.accumulate(step - shift[None, :], axis=1) + shift[None, :]  # extra characters in the document
        row = np.where(outside, far, step).astype(np.int32)
        done = lengths == j + 1
        if done.any():
            best[done] = row[done].min(axis=1)
            end[done] = diagonal[done] + j + 1 + row[done].argmin(axis=1)
    return best, end


def passages(texts: list[str | None], index: Index, present: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Text number, item number, begin and end in the text, and edits of each passage, best first where they overlap."""
    points, owner, place, begins = normalised(texts)
    item, diagonal = _bands(points, index, present)
    found = []
    for part in _batches(item, index):
        i, d = item[part], diagonal[part]
        edits, end = _align([index.texts[k] for k in i], points, d, 2 * index.width[i])
        ok = edits <= index.budget[i]
        i, edits, end = i[ok], edits[ok], end[ok]
        if len(i) == 0:
            continue
        back = points[::-1]  # the same from the end: where does the passage begin
        across = 2 * index.width[i]
        _, start = _align([index.texts[k][::-1] for k in i], back, len(points) - end - across // 2, across, ended=True)
        found += zip(i.tolist(), (len(points) - start).tolist(), end.tolist(), edits.tolist(), strict=True)
    out, taken = [], {}
    for i, a, b, edits in sorted(found, key=lambda x: (x[3], x[1], x[0])):
        text = int(owner[b - 1])
        a = max(a, int(begins[text]))
        if b > a and all(b <= x or a >= y for x, y in taken.get((text, i), ())):
            taken.setdefault((text, i), []).append((a, b))
            out.append((text, i, int(place[a]), int(place[b - 1]) + 1, edits))
    return out


def _blocks(items: DataFrame, item_id: str, text: str, q: int, percent: int) -> Iterator[Index]:
    ids, texts, size = [], [], 0
    for row in items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL").orderBy("i", "t").toLocalIterator():
        if ids and size + len(row["t"]) > BLOCK_CHARS:
            yield Index.of(ids, texts, q, percent)
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += len(row["t"])
    if ids:
        yield Index.of(ids, texts, q, percent)


def contaminated(
    df: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    q: int = GRAM, percent: int = PERCENT,
) -> DataFrame:
    """One row per passage: id, item id, ``begin`` and ``end`` (characters of the text) and ``edits``."""
    source = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind, item_kind = source.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, begin bigint, end bigint, edits bigint"
    item_type = to_arrow_type(items.schema[item_id].dataType)
    found = None
    for index in _blocks(items, item_id, item_text, q, percent):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            present = index.present()
            for whole in batches:
                for batch in slices(whole, 1, SLICE_BYTES):
                    rows = passages(batch.column(1).to_pylist(), index, present) if index.ids else []
                    cells = list(zip(*rows, strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(cells[0], pa.int64())), pa.array([index.ids[k] for k in cells[1]], item_type)]
                        + [pa.array(x, pa.int64()) for x in cells[2:]],
                        names=["id", "item", "begin", "end", "edits"],
                    )

        part = arrow_map(source, run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], schema)
    return found.select(F.col("id").alias(id), F.col("item").alias(item_id), "begin", "end", "edits")


def clean_rows(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` that hold no passage of any item, all columns."""
    at = df.columns.index(text)
    out = df.select(F.struct(*(df[c] for c in df.columns)).alias("row"))
    schema = out.schema
    for index in _blocks(items, item_id, item_text, GRAM, PERCENT):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            present = index.present()
            for whole in batches:
                begin = 0
                for part in slices(pa.RecordBatch.from_arrays([whole.column(0).field(at)], names=["t"]), 0, SLICE_BYTES):
                    keep = np.ones(part.num_rows, bool)
                    if index.ids:
                        keep[[x[0] for x in passages(part.column(0).to_pylist(), index, present)]] = False
                    yield whole.slice(begin, part.num_rows).filter(pa.array(keep))
                    begin += part.num_rows

        out = arrow_map(out, run, schema)
    return out.select("row.*")


def op3_decontamination(spark, folder):
    return contaminated(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLE = {}
