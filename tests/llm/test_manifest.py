"""The Merkle manifest against a plain walk over lists, for several fan-outs and page heights."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vigil.llm import manifest as mk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    values = [row[0], row[3], row[2], None if row[4] is None else row[4] + add, row[1]]
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def lines(nodes, fanout):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: lines([leaf_of(r) for r in groups[g]], fanout) for g in order}
    top = lines([trees[g][-1][0] for g in order], fanout)
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h, proof = leaf_of(r, int(tampered)), []
            for levels, at in ((trees[g], i), (top, k)):
                for line in levels[:-1]:
                    first, place = at // fanout * fanout, at % fanout
                    run = line[first : first + fanout]
                    others = run[:place] + run[place + 1 :]
                    proof += others
                    h = H([*others[:place], h, *others[place:]])
                    at //= fanout
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], H(proof), h, h == top[-1][0]))
    return sorted(out, key=repr)


def proven(df, fanout=2, levels=10):
    m = mk.manifest(df, carry={"tampered": mk.tampered_leaf(df)}, fanout=fanout, levels=levels)
    out = mk.proofs(m, m.leaves, ["id", "leaf", "tampered"])
    assert out.filter("found <> leaf").isEmpty()  # the descent ends at the leaf that was asked for
    root = mk.folded(F.coalesce("tampered", "leaf"), F.col("rank"), F.col("tree"), F.col("siblings"), F.col("height"), fanout)
    out = out.select("id", "leaf", "subroot", "root", F.sha2(F.array_join(F.flatten("siblings"), ""), 256), root, root == F.col("root"))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def table(n):
    rows = [(i, f"text {i}", ("en", "de", None, "é", "")[i % 7 % 5], None if i % 11 == 0 else f"s{i % 3}", None if i % 13 == 0 else i) for i in range(n)]
    rows += [(5000, None, "lone", None, None), (None, "no id", "en", "a", 1), (None, None, None, None, None)]
    return rows + [rows[3], rows[3], (rows[4][0], "other text", *rows[4][2:])]


@pytest.mark.parametrize("fanout,levels", [(2, 10), (2, 2), (3, 1), (5, 2)])
def test_proofs(spark, fanout, levels):
    rows = table(90)
    assert proven(spark.createDataFrame(rows, DOCS).repartition(5), fanout, levels) == brute(rows, fanout)


def test_small_and_empty(spark):
    for rows in ([(7, "x", "en", "s", 1)], [(1, "", None, None, None), (2, None, "a", "b", 2)], [(1, "same", "en", "s", 4)] * 9):
        assert proven(spark.createDataFrame(rows, DOCS), levels=2) == brute(rows)
    assert proven(spark.createDataFrame([], DOCS)) == []


def test_other_columns_are_not_hashed(spark):
    rows = table(10)
    df = spark.createDataFrame(rows, DOCS)
    for c in ("tree", "rank", "n", "leaf", "digest", "id", "group", "records", "__group", "__id"):
        df = df.withColumn(c, F.lit("x"))
    assert proven(df) == brute(rows)


def test_some_requests(spark):
    rows = table(40)
    df = spark.createDataFrame(rows, DOCS)
    m = mk.manifest(df, levels=2)
    asked = m.leaves.filter("rank % 5 = 1").select("tree", "rank")
    found = mk.proofs(m, asked)
    assert found.count() == asked.count() > 0
    assert found.join(m.leaves, ["tree", "rank"]).filter("found <> leaf").isEmpty()


def test_pages_are_addressed_by_content(spark):
    m = mk.manifest(spark.createDataFrame(table(40), DOCS), levels=2)
    for page in m.pages.collect():
        assert page["digest"] in [r["digest"] for r in page["records"]]
        for r in page["records"]:
            assert H(c.hex() for c in r["children"]) == r["digest"].hex()
