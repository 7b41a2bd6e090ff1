"""Language of words and texts by a linear-chain conditional random field.

Words are runs of letters. Each has affix features (its first and last one to three bytes), n-gram features (two to four
bytes) and a lexicon feature (the whole word), hashed into one weight table; transition and start weights are learned with
them by gradient steps on the likelihood, whose gradient comes from forward-backward. Training sequences are cut from
labelled texts, and half of them join two texts, so that switches inside a text are seen. Labelling runs forward-backward
over all words of an Arrow batch at once: the sequence is cut into equal pieces whose transfer products are combined.

The fit uses a bounded sample: at most ``MOST_ROWS`` rows over all languages (but one of each at least), of texts of at most
``MOST_CHARS`` characters: of every language as many rows of least hash of id and text, however many rows it has. Nothing else is sampled; every word of every text is labelled.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any labelled row every text is
``und``; ids may repeat or be null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import arrow_map, documents
from vigil.llm.words import U, byte_rows, keyed, mixed, slices, word_hashes

MOST_ROWS = 1200
MOST_CHARS = 20_000
DRAWS = 1 << 63
SLOTS = 1 << 17
LENGTH = 32
LEAST_SCORE = 0.5
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GRAM = keyed(8, 201) | U(1)


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature and language, transition and start weights."""

    langs: tuple[str, ...]
    weights: np.ndarray
    moves: np.ndarray
    starts: np.ndarray


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each run of letters, and for each row the number of words before it."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _LETTER[data]
    edge = inside[1:] != inside[:-1]
    begins, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    if len(cuts):
        begins, ends = np.sort(np.concatenate([begins, cuts])), np.sort(np.concatenate([ends, cuts]))
    return begins, ends, np.searchsorted(begins, offsets)


def word_features(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, and the word each belongs to, by word within each kind."""
    lengths = ends - begins + 2  # with a mark at either end: a gram that holds a mark is an affix
    first = np.cumsum(lengths) - lengths
    total = int(lengths.sum())
    marked = np.full(total, 1, U)
    inner = np.ones(total, bool)
    inner[first] = inner[first + lengths - 1] = False
    place = np.arange(int((lengths - 2).sum())) + np.repeat(begins - (np.cumsum(lengths - 2) - (lengths - 2)), lengths - 2)
    marked[inner] = _LOWER[data[place]].astype(U) + U(2)
    owner = np.repeat(np.arange(len(begins)), lengths)
    left = np.repeat(first + lengths, lengths) - np.arange(total)
    ids, owners = [], []
    with np.errstate(over="ignore"):
        for n in (2, 3, 4):
            if total < n:
                continue
            value = sum((marked[i : total - n + 1 + i] * _GRAM[i] for i in range(n)), U(n) * _GRAM[7])
            fits = left[: total - n + 1] >= n
            ids.append((mixed(value[fits]) % U(SLOTS)).astype(np.int32))
            owners.append(owner[: total - n + 1][fits])
        ids.append((mixed(word_hashes(data, begins, ends, lower=True) ^ _GRAM[6]) % U(SLOTS)).astype(np.int32))
        owners.append(np.arange(len(begins)))
    return np.concatenate(ids), np.concatenate(owners)


def emissions(weights: np.ndarray, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's features."""
    out = np.zeros((len(begins), weights.shape[1]))
    step = 1 << 15
    for at in range(0, len(begins), step):
        ids, owner = word_features(data, begins[at : at + step], ends[at : at + step])
        n = len(begins[at : at + step])
        for k in range(weights.shape[1]):
            out[at : at + n, k] = np.bincount(owner, weights[ids, k], n)
    return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)


def marginals(scores: np.ndarray, is_start: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Probability of each language at each word of the sequences that begin where ``is_start`` holds."""
    n, k = scores.shape
    size = max(1, int(np.sqrt(n)))
    pieces = -(-n // size)
    value = np.ones((pieces * size, k))
    value[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    fresh = np.ones(pieces * size, bool)
    fresh[:n] = is_start
    value, fresh = value.reshape(pieces, size, k), fresh.reshape(pieces, size)
    move, start = np.exp(moves - moves.max()), np.exp(starts - starts.max())

    product = np.broadcast_to(np.eye(k), (pieces, k, k)).copy()
    for t in range(size):
        new = np.where(fresh[:, t, None, None], product.sum(axis=2, keepdims=True) * start, product @ move)
        product = _scaled(new * value[:, t, None, :])
    enter = np.ones((pieces, k)) / k
    for b in range(1, pieces):
        x = enter[b - 1] @ product[b - 1]
        enter[b] = x / x.sum()
    leave = np.ones((pieces, k)) / k
    for b in range(pieces - 2, -1, -1):
        x = product[b + 1] @ leave[b + 1]
        leave[b] = x / x.sum()

    forward = np.empty((pieces, size, k))
    x = enter
    for t in range(size):
        x = np.where(fresh[:, t, None], x.sum(axis=1, keepdims=True) * start, x @ move)
        forward[:, t] = x = _scaled(x * value[:, t])
    x = leave
    for t in range(size - 1, -1, -1):
        forward[:, t] = _scaled(forward[:, t] * x)
        y = value[:, t] * x
        x = _scaled(np.where(fresh[:, t, None], (y @ start)[:, None] * np.ones(k), y @ move.T))
    return forward.reshape(pieces * size, k)[:n]


def _sequences(first: np.ndarray, labels: np.ndarray, seed: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and labels of training sequences: half are runs of one text, half join the halves of two runs."""
    runs, of = [], []
    for a, b, y in zip(first[:-1], first[1:], labels, strict=True):
        for at in range(a, b, LENGTH):
            run = np.arange(at, min(at + LENGTH, b))
            runs.append(np.resize(run, LENGTH))  # a short run repeats its words
            of.append(y)
    words = np.array(runs, np.int64).reshape(-1, LENGTH)
    tags = np.repeat(np.array(of, np.int64), LENGTH).reshape(-1, LENGTH)
    order = seed.permutation(len(words))
    joined, half = order[: len(order) // 4 * 2], LENGTH // 2
    left, right = joined[0::2], joined[1::2]
    for x in (words, tags):
        x[left, half:], x[right, half:] = x[right, half:].copy(), x[left, half:].copy()
    return words, tags


def fit(texts: list[str], labels: list[str], epochs: int = 4, batch: int = 512, rate: float = 0.3, seed: int = 7) -> Model:
    """Learn all weights from labelled texts (at most ``MOST_ROWS`` of them reach here)."""
    langs = tuple(sorted(set(labels)))
    k = len(langs)
    data, offsets = byte_rows(pa.array(texts, pa.string()))
    begins, ends, first = letter_words(data, offsets)
    model = Model(langs, np.zeros((SLOTS, k)), np.zeros((k, k)), np.zeros(k))
    if k < 2 or len(begins) == 0:
        return model
    random = np.random.default_rng(seed)
    words, tags = _sequences(first, np.searchsorted(langs, labels), random)
    _, example, number = np.unique(word_hashes(data, begins, ends, lower=True), return_index=True, return_inverse=True)
    ids, owner = word_features(data, begins[example], ends[example])
    by_word = np.argsort(owner, kind="stable")
    ids = ids[by_word]
    counts = np.bincount(owner, minlength=len(example))
    from_ = np.cumsum(counts) - counts
    squares = [np.full(x.shape, 1e-3) for x in (model.weights, model.moves, model.starts)]
    is_start = np.zeros((batch, LENGTH), bool)
    is_start[:, 0] = True
    for _ in range(epochs):
        order = random.permutation(len(words))
        for at in range(0, len(order), batch):
            w, y = number[words[order[at : at + batch]]], tags[order[at : at + batch]]
            used, place = np.unique(w, return_inverse=True)
            place = place.reshape(-1)
            n = counts[used]
            own = np.arange(int(n.sum())) + np.repeat(from_[used] - (np.cumsum(n) - n), n)
            feature, at_word = ids[own], np.repeat(np.arange(len(used)), n)
            score = np.stack([np.bincount(at_word, model.weights[feature, j], len(used)) for j in range(k)], axis=1)[place]
            gamma, pairs = _expected(score.reshape(*w.shape, k), model.moves, model.starts)
            truth = np.eye(k)[y]
            error = (gamma - truth).reshape(-1, k)
            by = np.stack([np.bincount(place, error[:, j], len(used)) for j in range(k)], axis=1)
            seen, slot = np.unique(feature, return_inverse=True)
            slope = np.stack([np.bincount(slot, by[at_word, j], len(seen)) for j in range(k)], axis=1) / len(w)
            squares[0][seen] += slope**2
            model.weights[seen] -= rate * slope / np.sqrt(squares[0][seen])
            observed = np.zeros((k, k))
            np.add.at(observed, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            for i, (x, g) in enumerate(((model.moves, (pairs - observed) / len(w)), (model.starts, (gamma[:, 0] - truth[:, 0]).mean(axis=0))), 1):
                squares[i] += g**2
                x -= rate * g / np.sqrt(squares[i])
    return model


def _expected(scores: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all places and expected transition counts of sequences of one length."""
    value = np.exp(scores - scores.max(axis=2, keepdims=True))
    move, start = np.exp(moves - moves.max()), np.exp(starts - starts.max())
    ahead = np.empty_like(value)
    ahead[:, 0] = _scaled(value[:, 0] * start)
    for t in range(1, value.shape[1]):
        ahead[:, t] = _scaled((ahead[:, t - 1] @ move) * value[:, t])
    back = np.ones((len(value), value.shape[2])) / value.shape[2]
    pairs = np.zeros_like(move)
    gamma = np.empty_like(value)
    for t in range(value.shape[1] - 1, -1, -1):
        gamma[:, t] = _scaled(ahead[:, t] * back)
        y = value[:, t] * back
        if t:
            joint = ahead[:, t - 1, :, None] * move * y[:, None, :]
            pairs += _scaled(joint).sum(axis=0)
        back = _scaled(y @ move.T)
    return gamma, pairs


def _least(labelled: DataFrame, each: int) -> list[tuple[str, str]]:
    """Language and text of the ``each`` rows of least hash of every language, in this order."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "text"))
    ranked = labelled.withColumn("place", place).filter(F.col("place") <= each).select("lang", "place", "text").collect()
    return [(r["lang"], r["text"]) for r in sorted(ranked, key=lambda r: (r["lang"], r["place"]))]


def train(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = MOST_ROWS) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fifth, evenly over languages."""
    labelled = df.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        (F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0) & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    # A longer text gives a stretch of this length from a place drawn by its hash, so that no language is lost.
    spare = F.length("text") - MOST_CHARS
    begin = F.pmod(F.xxhash64("id", "text"), spare + 1).cast("int") + 1
    labelled = labelled.withColumn("text", F.when(spare > 0, F.substring("text", begin, F.lit(MOST_CHARS))).otherwise(F.col("text")))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model((), np.zeros((1, 0)), np.zeros((0, 0)), np.zeros(0))
    each = max(1, rows // len(counts))
    labelled = labelled.withColumn("draw", F.shiftrightunsigned(F.xxhash64("id", "text"), 1))
    # The bound only keeps the ranking small: it leaves more than ``each`` rows, unless very many rows are equal.
    bounds = {name: min(DRAWS - 1, int((1.2 * each + 64) / n * DRAWS)) for name, n in counts.items()}
    bound = F.element_at(F.create_map(*(F.lit(x) for pair in sorted(bounds.items()) for x in pair)), F.col("lang"))
    drawn = _least(labelled.filter(F.col("draw") <= bound), each)
    taken = Counter(name for name, _ in drawn)
    short = sorted(name for name, n in counts.items() if taken[name] < min(each, n))
    if short:
        drawn = [x for x in drawn if x[0] not in short] + _least(labelled.filter(F.col("lang").isin(short)), each)
        drawn.sort(key=lambda x: x[0])
    return fit([t for _, t in drawn], [name for name, _ in drawn])


def _labelled(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = byte_rows(column)
    begins, ends, first = letter_words(data, offsets)
    if len(begins) == 0 or not model.langs:
        return begins, ends, first, offsets, np.zeros((0, len(model.langs)))
    _, example, number = np.unique(word_hashes(data, begins, ends, lower=True), return_index=True, return_inverse=True)
    scores = emissions(model.weights, data, begins[example], ends[example])[number]
    is_start = np.zeros(len(begins), bool)
    is_start[first[:-1][np.diff(first) > 0]] = True
    return begins, ends, first, offsets, marginals(scores, is_start, model.moves, model.starts)


def judge(column: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of its language (one beyond the last for ``und``) and the score."""
    _, _, first, offsets, odds = _labelled(column, model)
    n = np.diff(first)
    best, score = np.full(len(n), len(model.langs)), np.zeros(len(n))
    if len(odds):
        full = np.flatnonzero(n)
        means = np.add.reduceat(odds, first[:-1][full]) / n[full, None]
        best[full], score[full] = means.argmax(axis=1), np.minimum(1.0, means.max(axis=1))
        data, _ = byte_rows(column)
        plain = np.concatenate([[0], np.cumsum(_ASCII[data])])[offsets]
        for i in full[np.diff(plain)[full] == 0].tolist():  # other bytes than ASCII, which may be no letters at all
            if not any(map(str.isalpha, column[i].as_py())):
                best[i], score[i] = len(model.langs), 0.0
    return best, score


def identify(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred`` and ``score``, the mean probability of that language over the words."""
    source = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    langs = [*model.langs, UNKNOWN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                best, score = judge(batch.column(1), model)
                names = pa.array(langs).take(pa.array(best))
                yield pa.RecordBatch.from_arrays([batch.column(0), names, pa.array(score)], names=["id", "lang_pred", "score"])

    return arrow_map(source, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id)


def label_words(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of code-switched texts: per row the runs of words of one language, as byte ranges of the UTF-8 text."""
    source = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                begins, ends, first, offsets, odds = _labelled(batch.column(1), model)
                best = odds.argmax(axis=1) if model.langs and len(odds) else np.zeros(0, int)
                spans = []
                for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    row = []
                    if b > a and len(best):
                        cut = np.flatnonzero(np.diff(best[a:b])) + 1
                        for s, e in zip([0, *cut], [*cut, b - a], strict=True):
                            row.append({"begin": int(begins[a + s] - offsets[i]), "end": int(ends[a + e - 1] - offsets[i]), "lang": model.langs[best[a + s]]})
                    spans.append(row)
                kinds = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kinds)], names=["id", "spans"])

    return arrow_map(source, run, f"id {kind}, spans array<struct<begin:bigint,end:bigint,lang:string>>").withColumnRenamed("id", id)


def accepted(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` whose text has a recognised language, all columns; texts without letters and doubtful ones go.

    Where no row has a label there is nothing to judge by, and all rows stay.
    """
    model = train(df, id, text, lang)
    if not model.langs:
        return df
    names = df.columns
    kept = df.select(F.struct(*(df[c] for c in names)).alias("row"))
    schema, at = kept.schema, names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = pa.RecordBatch.from_arrays([whole.column(0).field(at)], names=["text"])
            begin = 0
            for part in slices(texts, 0):
                best, score = judge(part.column(0), model)
                keep = (best < len(model.langs)) & (score >= LEAST_SCORE)
                rows = whole.slice(begin, part.num_rows)
                begin += part.num_rows
                yield rows.filter(pa.array(keep))

    out = arrow_map(kept, run, schema)
    return out.select("row.*")


def op7_language_id(spark, folder):
    docs = documents(spark, folder)
    found = identify(docs, train(docs))
    return found.select(
        "doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op7_language_id": op7_language_id}
ORACLE = {}
