"""A Merkle manifest of a table as a content-addressed DAG, and proofs by descent from its root.

Every row is a leaf; the leaves of each group (``tree``) are numbered by id. ``fanout ** levels`` consecutive nodes go through
``levels`` rounds of hashing in one task, so a tree of any size takes a few rounds of grouping, and no group has more nodes than
that, whatever a tree's size. The records made there, digest to children, are stored in pages: one row per topmost digest, with
the records below it. Roots of the trees, in the order of their groups, are the leaves of one more tree, which has the root.

A request names a tree and a rank. Requests go down in strides of a page's levels: the distinct ranks above a stride are few,
each meets its page by digest, and inside the page the digits of the rank select one child per level while the other children
are collected. Strides lengthen the path of their parent; at the end the path is turned, as a proof goes up from the leaf.

Digests are lower-case hex SHA-256 and enter hashes as text; pages hold them as bytes.

Defined results: rows of equal id are numbered by their leaf digests, null ids come first; equal rows are leaves of equal digest;
a null group is a tree of its own and comes first; null texts and numbers are hashed as ``-``; a lone leaf is its tree's root and
a lone tree's root the whole root; an empty table has no root and gives an empty result; other columns are not hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from vigil.llm.common import arrow_map, documents, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10  # of a page: 1,024 nodes at its foot for a fanout of 2


@dataclass
class Manifest:
    """``leaves``: tree, n, rank, id, leaf and what was carried; ``trees``: tree, group, n, subroot; ``pages``: digest, records."""

    leaves: DataFrame
    trees: DataFrame
    pages: DataFrame
    top: DataFrame
    fanout: int
    levels: int


def digest_of(columns: list[Column]) -> Column:
    """Hash of values, each with its length in bytes before it and ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def height(n: int, fanout: int) -> int:
    """Levels of hashing above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _hash(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def _numbered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number rows (group, id, leaf) inside their group and groups among themselves: rows with tree and rank, and the trees.

    Rows are dealt by ranges of group, id and leaf, so a large group lies in many tasks; counts per task and group give the rest.
    """
    order = ["__group", "__id", "leaf"]
    place = F.monotonically_increasing_id()
    rows = stored(rows)  # ranges are drawn from what is written, so that texts are hashed once
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", place))
    placed = placed.withColumn("__task", F.shiftright("__place", 33))
    counts = placed.groupBy("__group", "__task").agg(F.count("*").alias("n"), F.min("__place").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("__group").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = stored(counts.withColumn("before", before))
    groups = counts.groupBy("__group").agg(F.sum("n").alias("n"))
    # groups are numbered like rows: by ranges, with counts per task
    sorted_groups = stored(groups.repartitionByRange("__group").sortWithinPartitions("__group").withColumn("__place", place))
    starts = sorted_groups.groupBy(F.shiftright("__place", 33).alias("task")).agg(F.count("*").alias("k"), F.min("__place").alias("start"))
    starts = starts.withColumn("skip", F.coalesce(F.sum("k").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sorted_groups = sorted_groups.join(starts, F.shiftright("__place", 33) == starts["task"])
    trees = stored(sorted_groups.select((F.col("__place") - F.col("start") + F.col("skip")).alias("tree"), F.col("__group").alias("group"), "n"))
    offsets = counts.join(trees, counts["__group"].eqNullSafe(trees["group"])).select(
        "tree", trees["n"].alias("n"), "group", F.col("__task").alias("task"), "first", "before"
    )
    found = placed.join(offsets, (placed["__task"] == offsets["task"]) & placed["__group"].eqNullSafe(offsets["group"]))
    rank = (F.col("__place") - F.col("first") + F.col("before")).alias("rank")
    return found.select("tree", "n", rank, *(c for c in rows.columns if c != "__group")), trees


def _pages(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Hash ``levels`` levels above nodes (tree, n, rank, digest): tree, n, rank and digest of what remains, and its records.

    ``n`` is the number of nodes of the tree on this level; a tree that is done earlier stops there.
    """
    stride = fanout**levels
    block = nodes.groupBy("tree", "n", F.floor(F.col("rank") / stride).alias("rank")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("foot")
    )
    block = block.select("tree", F.col("n").alias("below"), "rank", F.transform("foot", lambda x: x["digest"]).alias("foot"))
    schema = "tree long, n long, rank long, digest binary, records array<struct<digest:binary,children:array<binary>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                line, records = row["foot"], {}
                rounds = min(levels, height(row["below"], fanout))
                for _ in range(rounds):
                    runs = [line[i : i + fanout] for i in range(0, len(line), fanout)]
                    line = [_hash(x) for x in runs]
                    records.update(zip(line, runs, strict=True))
                listed = [{"digest": d, "children": c} for d, c in records.items()]
                out.append({"tree": row["tree"], "n": -(-row["below"] // stride), "rank": row["rank"], "digest": line[0], "records": listed})
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_PAGES)

    return arrow_map(block, run, schema)


_ARROW_PAGES = pa.schema(
    [
        ("tree", pa.int64()),
        ("n", pa.int64()),
        ("rank", pa.int64()),
        ("digest", pa.binary()),
        ("records", pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))),
    ]
)


def _hashed(nodes: DataFrame, most: int, fanout: int, levels: int) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (tree, digest) of trees of at most ``most`` leaves, and all their pages."""
    pages = []
    while True:
        done = stored(_pages(nodes, fanout, levels))
        pages.append(done.filter(F.size("records") > 0).select("digest", "records"))
        nodes, most = done.drop("records"), -(-most // fanout**levels)
        if most <= 1:
            return nodes.select("tree", "digest"), pages


def manifest(
    df: DataFrame, id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, carry: dict[str, Column] | None = None,
    fanout: int = 2, levels: int = LEVELS,
) -> Manifest:
    """Hash a table into a DAG and store its records; ``carry`` adds columns, computed from ``df``, to the leaves."""
    rows = df.select(
        F.col(group).alias("__group"), F.col(id).alias("__id"), digest_of([F.col(c) for c in fields]).alias("leaf"),
        *(c.alias(k) for k, c in (carry or {}).items()),
    )
    leaves, trees = _numbered(rows)
    leaves = stored(leaves.withColumnRenamed("__id", "id"))
    size = trees.agg(F.max("n"), F.count("*")).first()
    roots, pages = _hashed(leaves.select("tree", "n", "rank", F.unhex("leaf").alias("digest")), size[0] or 0, fanout, levels)
    trees = stored(trees.join(roots, "tree").withColumnRenamed("digest", "subroot"))
    tops = trees.select(F.lit(-1).cast("long").alias("tree"), F.lit(size[1]).cast("long").alias("n"), F.col("tree").alias("rank"), F.col("subroot").alias("digest"))
    top, more = _hashed(tops, size[1], fanout, levels)
    everything = pages[0]
    for page in [*pages[1:], *more]:
        everything = everything.unionByName(page)
    # pages of equal rows are equal; one of each stays
    return Manifest(leaves, trees, stored(everything.groupBy("digest").agg(F.first("records").alias("records"))), top, fanout, levels)


def _stride(at: DataFrame, wanted: DataFrame, m: Manifest, step: int, carry: list[str]) -> DataFrame:
    """One stride down: ``at`` has (tree, above, subroot, digest, path, height); ``wanted`` (tree, rank) and ``carry``, unique by these.

    Gives tree, rank, carried columns, subroot, height, digest and path of the wanted nodes ``step`` strides above the leaves.
    """
    size = m.fanout**m.levels
    fields = ["rank", *carry]
    asked = wanted.groupBy("tree", F.floor(F.col("rank") / size).alias("above")).agg(F.collect_list(F.struct(*fields)).alias("asked"))
    met = asked.join(at, ["tree", "above"]).join(m.pages, "digest", "left")
    met = met.select("tree", "height", "subroot", "digest", "path", "records", "asked")
    schema = wanted.select("tree", *fields).schema.add("height", "long").add("subroot", "binary").add("digest", "binary")
    schema = schema.add("path", ArrayType(ArrayType(BinaryType())))
    fanout, levels = m.fanout, m.levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                children = {r["digest"]: r["children"] for r in row["records"] or []}
                # a tree that ends inside this stride has fewer levels here
                down = max(0, min(levels, row["height"] - step * levels))
                digests, paths = [], []
                for request in row["asked"]:
                    node, path = row["digest"], list(row["path"])
                    for level in range(down - 1, -1, -1):
                        digit = request["rank"] // fanout**level % fanout
                        run_ = children[node]
                        path.append(run_[:digit] + run_[digit + 1 :])
                        node = run_[digit]
                    digests.append(node)
                    paths.append(path)
                asked = batch.column(6)[i].values
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * n, pa.int64()),
                        *(asked.field(k) for k in range(len(fields))),
                        pa.array([row["height"]] * n, pa.int64()),
                        pa.array([row["subroot"]] * n, pa.binary()),
                        pa.array(digests, pa.binary()),
                        pa.array(paths, pa.list_(pa.list_(pa.binary()))),
                    ],
                    names=schema.names,
                )

    return arrow_map(met, run, schema)


def _descended(start: DataFrame, wanted: DataFrame, most: int, m: Manifest, carry: list[str]) -> DataFrame:
    """From ``start`` (tree, subroot, digest, path, height) down to the wanted ranks of trees of at most ``most`` leaves."""
    strides = max(1, -(-height(most, m.fanout) // m.levels))
    at = start.select("tree", F.lit(0).cast("long").alias("above"), "subroot", "digest", "path", "height")
    for step in range(strides - 1, -1, -1):
        if step:
            ranks = wanted.select("tree", F.floor(F.col("rank") / (m.fanout**m.levels) ** step).alias("rank")).distinct()
            below = _stride(at, ranks, m, step, [])
            at = stored(below.select("tree", F.col("rank").alias("above"), "subroot", "digest", "path", "height"))
        else:
            return _stride(at, wanted, m, 0, carry)


def proofs(m: Manifest, requests: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Proofs of the requested leaves, by descent from the root.

    ``requests`` has tree, rank (each pair once, of existing leaves) and the columns to ``carry``. Per request: these, the tree's
    subroot, the root, the leaf's digest found at the end of the descent, and ``siblings``: for each level, from the leaf to
    the root, the other children of the run from left to right; the first ``height`` of them lie in the leaf's tree.
    """
    sizes = m.trees.agg(F.max("n"), F.count("*")).first()
    most, count = sizes[0] or 0, sizes[1]
    none = F.array().cast("array<array<binary>>").alias("path")
    root = m.top.select("tree", F.col("digest").alias("subroot"), "digest", none, F.lit(height(count, m.fanout)).cast("long").alias("height"))
    wanted = requests.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("rank")).distinct()
    subroots = stored(_descended(root, wanted, count, m, []).select(F.col("rank").alias("tree"), F.col("digest").alias("subroot"), "path"))
    levels = F.lit(0).cast("long")
    for k in range(height(most, m.fanout)):
        levels = levels + (F.col("n") > m.fanout**k).cast("long")
    start = subroots.join(m.trees.select("tree", "n"), "tree").select(
        "tree", "subroot", F.col("subroot").alias("digest"), "path", levels.alias("height")
    )
    keep = carry or []
    found = _descended(start, requests.select("tree", "rank", *keep), most, m, keep)
    first = m.top.first()
    siblings = F.transform(F.reverse("path"), lambda level: F.transform(level, lambda d: F.lower(F.hex(d))))
    return found.select(
        "tree", "rank", *keep, F.lower(F.hex("subroot")).alias("subroot"), F.lit(first and first["digest"].hex()).alias("root"),
        F.lower(F.hex("digest")).alias("found"), siblings.alias("siblings"), "height",
    )


def folded(leaf: Column, rank: Column, tree: Column, siblings: Column, levels: Column, fanout: int = 2) -> Column:
    """The root that follows from a leaf and its siblings; the first ``levels`` of them lie in the leaf's tree."""
    zero = F.struct(leaf.alias("h"), rank.alias("r"), levels.alias("left"))

    def up(acc: Column, level: Column) -> Column:
        place = F.when(acc["left"] == 0, tree).otherwise(acc["r"])  # at the tree's root, go on with its number among trees
        digit = (place % fanout).cast("int")
        before, after = F.slice(level, 1, digit), F.slice(level, digit + 1, F.greatest(F.size(level) - digit, F.lit(0)))
        joined = F.array_join(F.concat(before, F.array(acc["h"]), after), "")
        return F.struct(F.sha2(joined, 256).alias("h"), F.floor(place / fanout).alias("r"), (acc["left"] - 1).alias("left"))

    return F.aggregate(siblings, zero, up)["h"]


def tampered_leaf(df: DataFrame, fields: tuple[str, ...] = FIELDS) -> Column:
    """The leaf after 1 is added to n_chars of the rows whose id's crc32 is a multiple of 7; null for other rows."""
    changed = [F.try_add(c, F.lit(1)) if c == "n_chars" else F.col(c) for c in fields]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, digest_of(changed))


def op11_merkle(spark, folder):
    """Proof of every document against the root, with some of the documents tampered."""
    docs = documents(spark, folder)
    m = manifest(docs, carry={"tampered": tampered_leaf(docs)})
    out = proofs(m, m.leaves, ["id", "leaf", "tampered"])
    root = folded(F.coalesce("tampered", "leaf"), F.col("rank"), F.col("tree"), F.col("siblings"), F.col("height"))
    out = out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join(F.flatten("siblings"), ""), 256).alias("proof_sha256"), root.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op11_merkle": op11_merkle}
_FIELD = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')"
_LEAF = "sha256({})".format(" || ".join(_FIELD.format(f"CAST({c} AS VARCHAR)") for c in FIELDS))
_CRC = """
    xor(4294967295, list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1),
            lambda i: list_concat([CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT)], [CAST(-1 AS BIGINT), -1, -1, -1, -1, -1, -1, -1])))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))
"""
ORACLE = {
    "op11_merkle": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, lang, {_LEAF} AS leaf,
                   CASE WHEN ({_CRC}) % 7 = 0 THEN {_LEAF.replace("CAST(n_chars AS", "CAST(n_chars + 1 AS")} END AS tampered
            FROM documents),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves),
        numbered AS (
            SELECT row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree, lang, nodes
            FROM (SELECT lang, list(leaf ORDER BY rank) AS nodes FROM ranked GROUP BY lang)),
        lines AS (
            SELECT tree, lang, 0 AS level, nodes FROM numbered
            UNION ALL
            SELECT tree, lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2),
                   lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM lines WHERE len(nodes) > 1),
        subroots AS (SELECT tree, lang, level AS height, nodes[1] AS subroot FROM lines WHERE len(nodes) = 1),
        top AS (
            SELECT 0 AS level, (SELECT list(subroot ORDER BY tree) FROM subroots) AS nodes
            UNION ALL
            SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
            FROM top WHERE len(nodes) > 1),
        rows AS (SELECT r.*, s.tree, s.height, s.subroot FROM ranked r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang),
        fold AS (
            SELECT tree, rank, doc_id, leaf, subroot, height, 0 AS level, rank AS place, coalesce(tampered, leaf) AS h, '' AS proof FROM rows
            UNION ALL
            SELECT f.tree, f.rank, doc_id, leaf, subroot, height, f.level + 1, p.place // 2,
                   sha256(CASE WHEN p.place % 2 = 1 THEN coalesce(n.nodes[p.place], '') || h ELSE h || coalesce(n.nodes[p.place + 2], '') END),
                   proof || coalesce(n.nodes[CASE WHEN p.place % 2 = 1 THEN p.place ELSE p.place + 2 END], '')
            FROM fold f
            JOIN LATERAL (SELECT CASE WHEN f.level = f.height THEN f.tree ELSE f.place END AS place) p ON true
            JOIN (SELECT tree, level, nodes FROM lines WHERE len(nodes) > 1
                  UNION ALL
                  SELECT s.tree, s.height + t.level, t.nodes FROM subroots s, top t WHERE len(t.nodes) > 1) n
              ON n.tree = f.tree AND n.level = f.level),
        root AS (SELECT level AS above, nodes[1] AS root FROM top WHERE len(nodes) = 1)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
        FROM fold, root WHERE level = height + above
    """
}
