"""Near duplicates by MinHash: universal hash minima, banding, verification, and connected components.

1. Each text becomes a set of word shingles; of equal sets one document stands for all.
2. The set's minima under 144 universal hash functions form 36 bands of 4; sets that share a band are nominated. A pair at
   a similarity of exactly 0.75 shares none with a probability of about one in a million.
3. Every member of a bucket is compared with the bucket's first document on the full sets.
4. Only pairs of one bucket that are still in different components can add anything. The bucket's first document may be
   one of the least like the others, so each such bucket's members outside its main component are compared with the most
   central one of this component, that whose shingles are the most frequent: copies of one text that differ here and there
   are linked by it, however many there are.
5. The documents of buckets that are still open go through an exact prefix join: shingles are ordered from rare to frequent, and two sets can only be similar enough if the
   first shingle they share in this order has enough shingles behind it in both. So a set enters with its rare shingles
   only, the smaller set of a pair with fewer, and what many texts have in common (an opening, a template) is not looked
   up. Sizes, the shingles left behind the shared one, and a sketch of one bit per minimum (six standard deviations wide)
   decide inside the join's condition; the pairs that come out are confirmed on the full sets.
6. Components come from alternating large-star and small-star.

Defined results: null or empty texts, and texts without words, have no shingles and no links; a null id links nothing;
rows with one id count as one node; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import arrow_map, documents, stored
from vigil.llm.graph import components
from vigil.llm.words import U, byte_rows, keyed, mixed, slices, window_hashes, word_bounds, word_hashes

SHINGLE = 5
PERCENT = 75
BANDS = 36
ROWS = 4
MOST_BITS = 42
PIECE = 256  # pairs of one document that are confirmed by one copy of its set
_MULTIPLY = (keyed(BANDS * ROWS, 101) | U(1))[:, None]
_ADD = keyed(BANDS * ROWS, 102)[:, None]
_JOIN = keyed(ROWS, 103) | U(1)
_BAND = keyed(BANDS, 104)
_OTHER = keyed(1, 105)[0]
SIGNATURE = "n long, k0 long, k1 long, bands array<long>, w0 long, w1 long, w2 long"


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each row, ascending."""
    data, offsets = byte_rows(column)
    begins, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, begins, ends, lower=True)
    windows = window_hashes(words, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            yield window_hashes(words[a:b], b - a)
        else:
            yield np.zeros(0, U)


def minima(hashes: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, ~U(0))
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 512):
            values = _MULTIPLY * hashes[None, at : at + 512]
            values += _ADD
            np.minimum(low, values.min(axis=1), out=low)
    return low


def _signatures(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1):
            keys, bands, bits, counts = [], [], [], []
            with np.errstate(over="ignore"):
                for hashes in shingle_sets(batch.column(1), size):
                    low = minima(hashes)
                    counts.append(len(hashes))
                    keys.append((mixed(hashes).sum(), mixed(hashes ^ _OTHER).sum()))
                    bands.append(mixed((low.reshape(BANDS, ROWS) * _JOIN).sum(axis=1) + _BAND))
                    flags = np.zeros(192, bool)
                    flags[: BANDS * ROWS] = mixed(low) & U(1)
                    bits.append(np.packbits(flags).view(U))
            n = len(counts)
            keys, bits = np.array(keys, U).reshape(n, 2), np.array(bits, U).reshape(n, 3)
            flat = pa.array(np.concatenate(bands).view(np.int64)) if n else pa.array([], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), flat)
            parts = [np.ascontiguousarray(x).view(np.int64) for x in (*keys.T, *bits.T)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), *map(pa.array, parts[:2]), lists, *map(pa.array, parts[2:])],
                names=["id", "n", "k0", "k1", "bands", "w0", "w1", "w2"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1):
            sets = [x.view(np.int64) for x in shingle_sets(batch.column(1), size)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "shingles"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u``, ``v`` whose full sets are similar enough.

    A document that is ``u`` of many pairs meets them in several tasks: its set is copied once per ``PIECE`` pairs.
    """
    number = F.pmod(F.xxhash64("v"), F.col("pieces")).alias("piece")
    pieces = pairs.groupBy("u").agg(F.ceil(F.count("*") / PIECE).cast("long").alias("pieces"))
    left = sets.select(F.col("id").alias("u"), F.col("shingles").alias("x")).join(pieces, "u")
    left = left.select("u", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    right = sets.select(F.col("id").alias("v"), F.col("shingles").alias("y"))
    placed = pairs.join(pieces, "u").select("u", "v", number)
    both = F.size(F.array_intersect("x", "y")).cast("long")
    held = both * 100 >= (F.size("x") + F.size("y") - both) * percent
    return placed.join(right, "v").join(left, ["u", "piece"]).filter(held).select("u", "v")


def prefixes(reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The shingles ``s`` by which a set of ``reps`` may meet a similar one, with ``behind``, the set's size ``n`` and ``central``.

    Shingles of one member only order nothing: they stand before all others. ``behind`` is the number of a set's shingles
    from this one on, itself included; ``central`` is the mean frequency of its shingles.
    """
    items = sets.join(reps.select(F.col("rep").alias("id")), "id", "left_semi")
    items = items.select(F.col("id").alias("rep"), F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    shared = items.groupBy("s").agg(F.count("*").alias("f")).filter("f > 1")
    of_set = Window.partitionBy("rep")
    behind = F.row_number().over(of_set.orderBy(F.desc("f"), F.desc("s"))).cast("long")
    ranked = items.join(shared, "s").select("s", behind.alias("behind"), "rep", "n", (F.sum("f").over(of_set) / F.col("n")).alias("central"))
    return stored(ranked.filter(F.col("behind") * 100 >= F.col("n") * percent))


def _apart(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}"))) for i in range(3)), F.lit(0))


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int, found: DataFrame | None = None) -> DataFrame:
    """Pairs ``u``, ``v`` of different components that may be similar enough; none that is goes missing.

    ``members`` has ``rep``, ``comp``, ``outer`` (one of the two is outer in every pair), ``n`` and the sketch; ``sets`` has
    ``id`` and ``shingles``. ``found`` are the ``prefixes`` of these members, or of more.
    """
    found = prefixes(members, sets, percent) if found is None else found
    probe = stored(found.select("s", "behind", "rep").join(members, "rep"))
    index = probe.filter(F.col("behind") * (100 + percent) >= F.col("n") * (2 * percent))

    enough = F.least("a.behind", "b.behind") * (100 + percent) >= (F.col("a.n") + F.col("b.n")) * percent
    close = (
        (F.col("a.s") == F.col("b.s"))
        & (F.struct("a.n", "a.rep") < F.struct("b.n", "b.rep"))
        & (F.col("a.n") * 100 >= F.col("b.n") * percent)
        & enough
        & (F.col("a.comp") != F.col("b.comp"))
        & (_apart("a", "b") <= MOST_BITS)
    )
    met = None
    for small, large in ((index.filter("outer"), probe), (index.filter("NOT outer"), probe.filter("outer"))):
        pairs = small.alias("a").join(large.alias("b"), close)
        pairs = pairs.select(F.least("a.rep", "b.rep").alias("u"), F.greatest("a.rep", "b.rep").alias("v"))
        met = pairs if met is None else met.unionByName(pairs)
    return met.distinct()


def _open(places: DataFrame, roots: DataFrame) -> DataFrame:
    """``band``, ``rep``, ``comp`` and the bucket's ``main`` component, of buckets with members in several components."""
    placed = places.join(roots, places["rep"] == roots["node"], "left").select("band", "rep", F.coalesce("root", "rep").alias("comp"))
    parts = placed.groupBy("band", "comp").agg(F.count("*").alias("m")).groupBy("band")
    parts = parts.agg(F.count("*").alias("c"), F.max_by("comp", F.struct("m", "comp")).alias("main")).filter("c > 1")
    return stored(placed.join(parts.select("band", "main"), "band"))


def _members(places: DataFrame, sets: DataFrame) -> DataFrame:
    """Each document of open buckets once, with ``outer``: whether it is outside the main component of one of them."""
    outer = F.max(F.col("comp") != F.col("main")).alias("outer")
    return stored(places.groupBy("rep", "comp").agg(outer).join(sets.select("rep", "n", "w0", "w1", "w2"), "rep"))


def central_pairs(places: DataFrame, members: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's most central member of its main component and its members of other components.

    At most one per place. ``found`` are the ``prefixes`` of the members: without any a set is similar to none.
    """
    central = found.groupBy("rep").agg(F.first("central").alias("central"))
    item = F.struct("rep", "n", "w0", "w1", "w2")
    facing = members.join(central, "rep").select("rep", "central", item.alias("b")).join(places, "rep")
    leads = facing.filter("comp = main").groupBy("band").agg(F.max_by("b", F.struct("central", "rep")).alias("a"))
    sizes = F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent
    met = facing.filter("comp <> main").join(leads, "band").filter(sizes & (_apart("a", "b") <= MOST_BITS))
    return met.select(F.col("a.rep").alias("u"), F.col("b.rep").alias("v")).distinct()


def near_duplicates(
    df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (least id reachable over links) and ``kept``."""
    bare = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = bare.schema["id"].dataType.simpleString()
    signed = stored(arrow_map(bare, lambda b: _signatures(b, size), f"id {kind}, {SIGNATURE}"))
    key = ["n", "k0", "k1"]
    rest = [F.first(c).alias(c) for c in ("bands", "w0", "w1", "w2")]
    sets = stored(signed.filter("n > 0 AND id IS NOT NULL").groupBy(*key).agg(F.min("id").alias("rep"), *rest))

    entries = sets.select(F.explode("bands").alias("band"), "rep")
    shared = stored(entries.groupBy("band").agg(F.count("*").alias("m"), F.min("rep").alias("lead")).filter("m > 1"))
    members = stored(entries.join(shared.select("band", "lead"), "band"))

    needed = members.select(F.col("rep").alias("id")).distinct()
    full = stored(arrow_map(bare.join(needed, "id", "left_semi"), lambda b: _full_sets(b, size), f"id {kind}, shingles array<long>"))
    stars = members.filter("rep <> lead").select(F.col("lead").alias("u"), F.col("rep").alias("v")).distinct()
    links = stored(_confirmed(stars, full, percent))
    roots = components(links)

    # the bucket's first document has been compared with all others
    places = _open(members.filter("rep <> lead").select("band", "rep"), roots)
    rest = _members(places, sets)
    if not rest.filter("outer").isEmpty():
        rare = prefixes(rest, full, percent)
        more = stored(_confirmed(stored(central_pairs(places, rest, rare, percent)), full, percent))
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))
            places = _open(places.select("band", "rep"), roots)
            rest = _members(places, sets)
        more = stored(_confirmed(stored(prefix_pairs(rest, full, percent, rare)), full, percent))
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))

    of_set = sets.join(roots, sets["rep"] == roots["node"], "left").select(*key, F.coalesce("root", "rep").alias("comp"))
    found = signed.select("id", *key).join(of_set, key, "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    return found.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        comp.alias("component_id"),
        F.col("id").eqNullSafe(comp).alias("kept"),
    )


def kept_rows(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose document stays: one per component, all columns."""
    keep = near_duplicates(df, id, text).filter("kept").select(F.col(id).alias("__id")).distinct()
    return df.join(keep, df[id].eqNullSafe(keep["__id"]), "left_semi")


def op6_minhash_near_dedup(spark, folder):
    return near_duplicates(documents(spark, folder))


QUERIES = {"op6_minhash_near_dedup": op6_minhash_near_dedup}
ORACLE = {
    "op6_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 5
                   THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                   WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w
        ), n AS (SELECT doc_id, len(sh) AS n FROM s),
        e AS (SELECT doc_id, unnest(sh) AS sh FROM s),
        p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
        r AS (SELECT doc_id AS u, doc_id AS v FROM n UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
        c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c ON c.u = n.doc_id
    """
}
