"""Long passages that repeat, found on a compacted de Bruijn graph of the corpus.

The token k-mers (``size`` consecutive words) are the edges; edges that occur twice are to be found with their places.

1. Paths. The edges of a document that share an anchor (the least word 8-gram of the edge, leftmost of equals) follow one
   another and form one path. Equal edges have equal anchors, so an edge can only repeat under a repeated anchor. One row
   per path, about one per 14 words, instead of one per word.
2. Compaction. A join gives every path its anchor's count and whether all paths under it have the same words. If so, nothing
   branches there: the whole path repeats and stays one row. Paths of which an equal one exists repeat as a whole, too.
3. Branches. The other paths under a repeated anchor leave or enter a shared passage. Only they are taken apart: one row per
   edge of each different path, weighted with the number of its occurrences.
4. Coordinates. Repeated paths and edges return to the documents by place; there they join to spans of words, and the text
   itself gives the words that stay.

Steps 3 and 4 read the documents from the same exchange. Rolling hashes only choose anchors, so that two of them being equal
costs time and never a word. What repeats is decided by the words at the coordinates of a path or an edge: 128 bits of their
BLAKE2b digest, the words joined by single spaces.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Defined results: null or empty texts and texts of fewer than ``size`` words
have no edges; rows that repeat are different places; ids may repeat or be null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import arrow_map, documents, dropped, stored
from vigil.llm.words import U, byte_rows, slices, spaced_words, window_hashes, word_bounds, word_hashes

SIZE = 35
ANCHOR = 8
KEY = ["k1", "k2"]
CONTENT = ["c1", "c2"]
PIECE = 5_000
MOST_CUT = 200_000
PATH = "k1 bigint, k2 int, s int, n int, anchor bigint, c1 bigint, c2 bigint"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have, reach = values, 1
    while reach * 2 <= width:
        have = np.minimum(have[:-reach], have[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def digests(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Two 64-bit halves of the digest of the words ``first`` to ``last``, both included; white space does not count."""
    text, at = spaced_words(data, begins, ends)
    view = memoryview(text)
    bounds = zip(at[first].tolist(), (at[last] + ends[last] - begins[last]).tolist(), strict=True)
    made = b"".join([blake2b(view[b:e], digest_size=16).digest() for b, e in bounds])
    return np.frombuffer(made, np.int64).reshape(-1, 2)


def paths(column: pa.Array, size: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Row, first word, number of edges, anchor hash and content digest (two values) of each path of a column."""
    data, offsets = byte_rows(column)
    begins, ends, first = word_bounds(data, offsets)
    starts = np.zeros(len(begins) + 1, np.int64)
    whole = np.diff(first) >= size
    np.add.at(starts, first[:-1][whole], 1)
    np.add.at(starts, first[1:][whole] - size + 1, -1)
    at = np.flatnonzero(np.cumsum(starts[:-1]) > 0)
    if len(at) == 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams = window_hashes(word_hashes(data, begins, ends), anchor)
    ranked = (grams >> U(32) << U(32)) | np.arange(len(grams), dtype=U)
    place = (_least(ranked, size - anchor + 1)[at] & U(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(first, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(at)))
    begin = at[head]
    content = digests(data, begins, ends, begin, begin + n - 2 + size)
    return row[head], begin - first[row[head]], n, grams[place[head]].view(np.int64), content[:, 0], content[:, 1]


def _keyed(df: DataFrame, id: str, text: str) -> DataFrame:
    """Id and text with a key of the row that is never null; equal rows share it."""
    bare = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return bare.select(F.xxhash64("id", "text").alias("k1"), F.hash("text", "id").alias("k2"), "id", "text")


def _branch_edges(docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """One row per edge of the listed paths: its digest, place, and how often its path occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                data, offsets = byte_rows(batch.column(2))
                begins, ends, first = word_bounds(data, offsets)
                lists = batch.column(3)
                doc = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
                s, n, m = (np.asarray(x).astype(np.int64) for x in lists.flatten().flatten())
                edge = np.arange(int(n.sum())) + np.repeat(s - (np.cumsum(n) - n), n)
                of = np.repeat(doc, n)
                at = first[of] + edge
                content = digests(data, begins, ends, at, at + size - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of)), batch.column(1).take(pa.array(of)), pa.array(edge.astype(np.int32)),
                     pa.array(content[:, 0]), pa.array(content[:, 1]), pa.array(np.repeat(m, n))],
                    names=["k1", "k2", "s", "c1", "c2", "m"],
                )

    lists = reps.groupBy("rep.k1", "rep.k2").agg(F.collect_list(F.struct("rep.s", "rep.n", "m")).alias("parts"))
    listed = docs.join(lists, KEY).select(*KEY, "text", "parts")
    return arrow_map(listed, run, "k1 bigint, k2 int, s int, c1 bigint, c2 bigint, m bigint")


def _with_group(places: DataFrame, groups: DataFrame, by: list[str], weight: str, total: int) -> DataFrame:
    """Join places to their group by ``by``; a group of many places is cut into pieces of ``PIECE`` or a bit more.

    ``total`` bounds the sum of the weights, so at most ``MOST_CUT`` groups are cut; only these are broadcast.
    """
    piece = max(PIECE, -(-total // MOST_CUT))
    pieces = F.ceil(F.col(weight) / piece)
    cut = groups.filter(F.col(weight) > piece).select(*by, pieces.alias("pieces"))
    piece_of = F.coalesce(F.pmod(F.xxhash64(*KEY, "s"), F.col("pieces")), F.lit(0).cast("long"))
    dealt = places.join(F.broadcast(cut), by, "left").withColumn("piece", piece_of).drop("pieces")
    each = groups.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)))
    return dealt.join(each, [*by, "piece"]).drop("piece", weight)


def repeated_parts(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """Per row key the repeated edges as a list of (first word, number of edges)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                row, s, n, *rest = paths(batch.column(2), size, anchor)
                keys = [batch.column(i).take(pa.array(row)) for i in range(2)]
                places = [pa.array(x.astype(np.int32)) for x in (s, n)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, *places, *map(pa.array, rest)], names=["k1", "k2", "s", "n", "anchor", *CONTENT]
                )

    found = stored(arrow_map(docs.select(*KEY, "text"), run, PATH))
    bounds = [f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in CONTENT]
    anchors = found.groupBy("anchor").agg(F.count("*").alias("c"), *bounds).filter("c > 1")
    anchors = stored(anchors.select("anchor", "c", F.expr("minc1 != maxc1 OR minc2 != maxc2").alias("branches")))
    total = found.count()
    shared = stored(_with_group(found, anchors, ["anchor"], "c", total))
    dropped(found)
    straight = shared.filter("NOT branches").select(*KEY, "s", "n")
    branching = shared.filter("branches")
    # equal words have equal anchors
    contents = stored(branching.groupBy(*CONTENT).agg(F.count("*").alias("m"), F.min(F.struct(*KEY, "s", "n")).alias("rep")))
    whole = _with_group(branching, contents.filter("m > 1").select(*CONTENT, "m"), CONTENT, "m", total).select(*KEY, "s", "n")
    edges = _branch_edges(docs, contents, size)
    twice = edges.groupBy(*CONTENT).agg(F.sum("m").alias("all")).filter("all > 1")
    most = total * (size - anchor + 1)  # edges of a path share an anchor inside each of them
    single = _with_group(edges.filter("m = 1"), twice, CONTENT, "all", most).select(*KEY, "s", F.lit(1).alias("n"))
    parts = straight.unionByName(whole).unionByName(single)
    return parts.groupBy(*KEY).agg(F.collect_list(F.struct("s", "n")).alias("parts"))


def _covered(words: int, parts, size: int) -> np.ndarray:
    change = np.zeros(words + 1, np.int64)
    for p in parts:
        change[p["s"]] += 1
        change[p["s"] + p["n"] - 1 + size] -= 1
    return np.cumsum(change[:-1]) > 0


def without_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``spans`` of repeated words and ``kept_text``.

    Every word that a repeated window of ``size`` words covers goes; the others are joined by single spaces.
    """
    docs = _keyed(df, id, text)
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, 1):
                count, gone, spans, kept = [], [], [], []
                for t, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    words = (t or "").encode().split()
                    count.append(len(words))
                    if not parts:
                        gone.append(0)
                        spans.append([])
                    else:
                        covered = _covered(len(words), parts, size)
                        edge = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]]))).tolist()
                        spans.append([{"begin": a, "end": b} for a, b in zip(edge[0::2], edge[1::2], strict=True)])
                        gone.append(int(covered.sum()))
                        words = [words[i] for i in np.flatnonzero(~covered).tolist()]
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(count, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.string())],
                    names=["id", "n_words", "n_removed", "spans", "kept_text"],
                )

    placed = docs.join(repeated_parts(docs, size, anchor), KEY, "left").select("id", "text", "parts")
    schema = f"id {kind}, n_words bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept_text string"
    return arrow_map(placed, run, schema).withColumnRenamed("id", id)


def op2_substring_dedup(spark, folder):
    found = without_repeats(documents(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLE = {
    "op2_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        e AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS p, ws FROM w WHERE len(ws) >= 35),
        g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY sha256(array_to_string(ws[p:p + 34], ' '))) AS n FROM e),
        c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM g WHERE n > 1),
        r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
        SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
               sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN ws
                   ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END, ' '), '')) AS kept_sha256
        FROM w LEFT JOIN r ON r.doc_id = w.doc_id
    """
}
