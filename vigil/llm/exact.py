"""Exact duplicates by composable polynomial fingerprints.

A text's bytes are the digits of a polynomial, taken modulo three primes below 2**31. Chunks are hashed side by side and
joined by length-shifted arithmetic: ``H(a + b) = H(a) * B**len(b) + H(b)``, so the parts of a huge document may lie in
different rows, tasks or machines. Equal fingerprints only nominate texts: their bytes are then compared chunk by chunk,
in an aggregation that keeps one chunk per task and group however many copies there are.

Defined results: a null text counts as empty; an empty table gives an empty result; ids may repeat or be null (nulls of a
group lose against any id; rows with the id that stays are all kept, they are the same document); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import arrow_map, documents, stored
from vigil.llm.words import byte_rows

PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (1000003, 754974721 % 2147483629, 998244353)
CHUNK = 4096
COMPARED = 1 << 16
PRINT = ["h0", "h1", "h2", "n_bytes"]
FIELDS = pa.schema([(f"h{i}", pa.int64()) for i in range(3)] + [(f"s{i}", pa.int64()) for i in range(3)] + [("n_bytes", pa.int64())])


def _table(base: int, prime: int) -> np.ndarray:
    out = np.empty(CHUNK + 1, np.int64)
    value = 1
    for i in range(CHUNK + 1):
        out[i] = value
        value = value * base % prime
    return out


_TABLES = [_table(b, p) for b, p in zip(BASES, PRIMES, strict=True)]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Fingerprint and shift ``B**length`` of every row for each prime, from the hashes of its chunks."""
    lengths = np.diff(offsets)
    chunks = -(-lengths // CHUNK)
    row = np.repeat(np.arange(len(lengths)), chunks)
    number = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begins = offsets[:-1][row] + number * CHUNK
    sizes = np.minimum(CHUNK, offsets[1:][row] - begins)
    hashes = np.empty((3, len(row)), np.int64)
    step = 256
    for at in range(0, len(row), step):
        b, n = begins[at : at + step], sizes[at : at + step]
        digits = data[b[0] : b[-1] + n[-1]].astype(np.int64) + 1
        to_end = np.repeat(b + n - 1 - b[0], n) - np.arange(len(digits))
        for k in range(3):
            hashes[k, at : at + step] = np.add.reduceat(digits * _TABLES[k][to_end], b - b[0]) % PRIMES[k]
    whole, shift = [], []
    order = np.argsort(number, kind="stable")
    rounds = np.searchsorted(number[order], np.arange(number.max() + 2 if len(number) else 1))
    for k in range(3):
        h, s = np.zeros(len(lengths), np.int64), np.ones(len(lengths), np.int64)
        for a, b in zip(rounds[:-1], rounds[1:], strict=True):
            i = order[a:b]
            by = _TABLES[k][sizes[i]]
            h[row[i]] = (h[row[i]] * by + hashes[k, i]) % PRIMES[k]
            s[row[i]] = s[row[i]] * by % PRIMES[k]
        whole.append(h)
        shift.append(s)
    return whole, shift


def with_fingerprints(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the fingerprint (h0..h2), shift (s0..s2) and byte length of each row's text."""
    source = df.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = source.select(*keep).schema
    for f in FIELDS:
        schema = schema.add(f.name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_rows(batch.column(batch.num_columns - 1))
            whole, shift = fingerprints(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, whole), *map(pa.array, shift), pa.array(np.diff(offsets))],
                names=[*keep, *FIELDS.names],
            )

    return arrow_map(source, run, schema)


def combine_parts(parts: DataFrame, by: str, order: str) -> DataFrame:
    """Fingerprint of each whole document from those of its parts (rows of ``with_fingerprints``), in any distribution."""
    fields = [f"{x}{k}" for x in "hs" for k in range(3)]
    listed = parts.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(order, *fields, "n_bytes"))).alias("parts"))

    def joined(acc: Column, x: Column) -> Column:
        values = [((acc[f"h{k}"] * x[f"s{k}"] + x[f"h{k}"]) % PRIMES[k]).alias(f"h{k}") for k in range(3)]
        values += [((acc[f"s{k}"] * x[f"s{k}"]) % PRIMES[k]).alias(f"s{k}") for k in range(3)]
        return F.struct(*values, (acc["n_bytes"] + x["n_bytes"]).alias("n_bytes"))

    zero = F.struct(*(F.lit(int(f[0] == "s")).cast("long").alias(f) for f in fields), F.lit(0).cast("long").alias("n_bytes"))
    return listed.select(by, F.aggregate("parts", zero, joined).alias("whole")).select(by, "whole.*")


def _same_chunks(texts: DataFrame, by: list[str]) -> DataFrame:
    """Keys of ``by`` under which some chunk differs between texts."""
    raw = F.col("bytes")
    count = F.greatest(F.lit(1), F.ceil(F.length(raw) / COMPARED)).cast("int")
    chunks = texts.select(*by, raw, F.explode(F.sequence(F.lit(0), count - 1)).alias("number")).select(
        *by, "number", F.substring(raw, F.col("number") * COMPARED + 1, F.lit(COMPARED)).alias("chunk")
    )
    compared = chunks.groupBy(*by, "number").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    return compared.filter("low <> high").select(*by).distinct()


def exact_dedup(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when their bytes are. Of equal texts the row with the largest id stays.
    """
    bare = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    prints = stored(with_fingerprints(bare.withColumn("sha", digest), "text", ["id", "sha"]).select("id", "sha", *PRINT))
    groups = stored(prints.groupBy(*PRINT).agg(F.count("*").alias("size"), F.max("id").alias("keep")).filter("size > 1"))
    nominated = prints.join(groups.select(*PRINT), PRINT, "left_semi").distinct()
    again = bare.select(F.col("id").alias("i"), digest.alias("s"), F.encode("text", "UTF-8").alias("bytes"))
    texts = again.join(nominated, again["i"].eqNullSafe(nominated["id"]) & (again["s"] == nominated["sha"]))
    split = stored(_same_chunks(texts.select(*PRINT, "bytes"), PRINT))
    found = prints.join(groups, PRINT, "left")
    if not split.isEmpty():  # different texts with one fingerprint: their groups are formed by the texts themselves
        doubtful = prints.join(split, PRINT, "left_semi")
        own = again.join(doubtful, again["i"].eqNullSafe(doubtful["id"]) & (again["s"] == doubtful["sha"]), "left_semi")
        own = own.groupBy("bytes").agg(F.first("s").alias("sha"), F.count("*").alias("own_size"), F.max("i").alias("own_keep"))
        found = found.join(own.select("sha", "own_size", "own_keep"), "sha", "left")
        found = found.withColumn("size", F.coalesce("own_size", "size"))
        found = found.withColumn("keep", F.when(F.col("own_size").isNotNull(), F.col("own_keep")).otherwise(F.col("keep")))
    keep = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))
    return found.select(
        F.col("id").alias(id),
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def kept_rows(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns; rows that repeat the id and text that stay count as one."""
    keep = exact_dedup(df, id, text).filter("kept").groupBy(F.col(id).alias("__id"), F.col("text_sha256").alias("__sha"))
    keep = stored(keep.agg(F.count("*").alias("__rows")))
    digest = F.sha2(F.encode(F.coalesce(df[text], F.lit("")), "UTF-8"), 256)
    stay = df.join(keep, df[id].eqNullSafe(keep["__id"]) & (digest == keep["__sha"]), "left_semi")
    return stay if keep.filter("__rows > 1").isEmpty() else stay.dropDuplicates([id, text])


def op10_exact_dedup(spark, folder):
    return exact_dedup(documents(spark, folder))


QUERIES = {"op10_exact_dedup": op10_exact_dedup}
ORACLE = {
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """
}
