"""Exact and near duplicates, components and repeated passages against brute force."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vigil.llm import exact, graph, near, repeats, words


def test_fingerprints_compose():
    random.seed(1)
    texts = ["", "a", "b" * 4096, "c" * 4097, "".join(random.choices("abcdé", k=20_000))]
    data, offsets = words.byte_rows(pa.array(texts))
    whole, _ = exact.fingerprints(data, offsets)
    for k in range(3):
        for i, t in enumerate(texts):
            value = 0
            for byte in t.encode():
                value = (value * exact.BASES[k] + byte + 1) % exact.PRIMES[k]
            assert whole[k][i] == value


def test_parts_in_any_rows_give_the_whole(spark):
    text = "".join(random.Random(2).choices("xyz é", k=30_000))
    cuts = [0, 17, 4096, 9000, 30_000]
    parts = [(7, n, text[a:b]) for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    df = spark.createDataFrame(parts, "doc long, part int, text string").repartition(4)
    joined = exact.combine_parts(exact.with_fingerprints(df, "text", ["doc", "part"]), "doc", "part").first()
    one = exact.with_fingerprints(spark.createDataFrame([(7, text)], "doc long, text string"), "text", ["doc"]).first()
    assert all(joined[c] == one[c] for c in exact.PRINT)


def expected_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""]) for i, t in rows), key=repr)


@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(spark, monkeypatch, collide):
    rows = [(i, f"text {i % 7}" * (1 + i % 3)) for i in range(60)] + [(100, None), (101, ""), (None, "text 1"), (5, "text 5")]
    rows += [(200, "z" * 200_000), (201, "z" * 199_999 + "y"), (202, "z" * 200_000)]
    if collide:  # every text has the same fingerprint

        def constant(df, text, keep):
            return df.select(*keep, *(F.lit(1).cast("long").alias(f) for f in exact.FIELDS.names))

        monkeypatch.setattr(exact, "with_fingerprints", constant)
    found = exact.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r[0], r[1], r[2], r[3]) for r in found), key=repr) == expected_exact(rows)


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = ["".join(c.lower() if c.isascii() else c for c in x.decode()) for x in (t or "").encode().split()]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def test_near_groups_of_unlike_members(spark):
    """Edited copies of three bases: within a group many pairs lie below the bound, some members link to few others."""
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(3):
        base = pick.choices(vocabulary, k=150)
        for _ in range(70):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 3, 4, 6, 8])):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + i, " ".join(pick.choices(vocabulary, k=pick.randint(1, 60)))) for i in range(60)]
    rows += [(900, "A b C d"), (901, "a B c D"), (902, "a b c"), (903, None), (904, ""), (905, "É x y z q"), (906, "é x y z q")]
    pick.shuffle(rows)
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == brute_near(rows)


def test_prefix_pairs_lose_none(spark):
    """Sets of one component each: all pairs at the bound or above come out, at exactly 0.75 too."""
    pick = random.Random(4)
    sets = []
    for _ in range(12):
        base = pick.sample(range(400), 40)
        for _ in range(8):
            sets.append(sorted(set(base[: pick.randint(30, 40)]) | set(pick.sample(range(400), pick.choice([0, 2, 5])))))
    sets += [[900, 901, 902], [900, 901, 902, 903], [900, 901, 904, 905]]
    full = spark.createDataFrame(list(enumerate(sets)), "id long, shingles array<long>")
    rows = [(i, i, i % 3 > 0, len(s), 0, 0, 0) for i, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "rep long, comp long, outer boolean, n long, w0 long, w1 long, w2 long")
    expected = set()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(set(x) & set(y))
            if (i % 3 or j % 3) and 100 * both >= 75 * (len(x) + len(y) - both):
                expected.add((j, i))
    assert (len(sets) - 3, len(sets) - 2) in expected
    found = near.prefix_pairs(members, full, 75)
    assert found.count() == found.distinct().count()
    assert {tuple(r) for r in near._confirmed(found, full, 75).collect()} == expected


def test_template_texts_pair_by_their_own_words_only(spark):
    """Texts with one long opening, alike below the bound: no pair is nominated, so work does not grow with their square."""
    pick = random.Random(5)
    sets = [[*range(200), *pick.sample(range(1000, 1 << 40), 60)] for _ in range(60)]
    full = spark.createDataFrame(list(enumerate(sets)), "id long, shingles array<long>")
    rows = [(i, i, True, len(s), 0, 0, 0) for i, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "rep long, comp long, outer boolean, n long, w0 long, w1 long, w2 long")
    assert near.prefix_pairs(members, full, 75).count() == 0


def test_copies_of_one_text_are_linked_by_a_central_one(spark, monkeypatch):
    pick = random.Random(9)
    base = [f"w{pick.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(160):  # the first of each bucket is one of those least like the others
        text = list(base)
        for at in pick.sample(range(150), 3 if i < 60 else 1):
            text[at] = f"x{i}-{at}"
        rows.append((i, " ".join(text)))
    met, own = [], near.prefix_pairs

    def counted(*given):
        pairs = own(*given)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(near, "prefix_pairs", counted)
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == brute_near(rows)
    assert sum(met) <= len(rows)


def test_pairs_of_one_hub_are_confirmed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(near, "PIECE", 3)
    full = spark.createDataFrame([(i, [1, 2, 3, 10 + i % 2]) for i in range(40)], "id long, shingles array<long>")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 40)], "u long, v long")
    found = sorted(tuple(r) for r in near._confirmed(pairs, full, 75).collect())
    assert found == [(0, i) for i in range(2, 40, 2)]


def test_components(spark):
    pick = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, 300 + i) for i in range(50)] + [(pick.randrange(400, 460), pick.randrange(400, 460)) for _ in range(40)]
    links += [(5, 5), (7, 6), (None, 3), (3, None)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for u, v in links:
        if u is not None and v is not None:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    want = sorted((i, find(i)) for i in root if find(i) != i)
    assert sorted(map(tuple, graph.components(spark.createDataFrame(links, "u long, v long")).collect())) == want
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_repeats(rows, size):
    places = {}
    lists = [(t or "").encode().split() for _, t in rows]
    for r, w in enumerate(lists):
        for p in range(len(w) - size + 1):
            places.setdefault(tuple(w[p : p + size]), []).append((r, p))
    gone = [set() for _ in rows]
    for found in places.values():
        if len(found) > 1:
            for r, p in found:
                gone[r].update(range(p, p + size))
    return sorted(((i, len(w), len(g), b" ".join(x for k, x in enumerate(w) if k not in g).decode()) for (i, _), w, g in zip(rows, lists, gone, strict=True)), key=repr)


def _with_equal_hashes(column, size, anchor):
    """Paths of a process in which all words have the same rolling hash."""
    from vigil.llm import repeats as there

    own = there.word_hashes
    there.word_hashes = lambda data, begins, ends: np.full(len(begins), 7, np.uint64)
    try:
        return there.paths(column, size, anchor)
    finally:
        there.word_hashes = own


@pytest.mark.parametrize("collide", [False, True])
@pytest.mark.parametrize(("size", "anchor", "letters"), [(6, 2, 3), (12, 4, 6), (35, 8, 400)])
def test_repeats(spark, monkeypatch, size, anchor, letters, collide):
    if collide:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
        monkeypatch.setattr(repeats, "paths", _with_equal_hashes)
        monkeypatch.setattr(repeats, "PIECE", 2)  # groups of three places are cut
        monkeypatch.setattr(repeats, "MOST_CUT", 1_000_000)
    pick = random.Random(size)
    vocabulary = [f"v{i}" for i in range(letters)]
    shared = [pick.choices(vocabulary, k=size + pick.randrange(3 * size)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = pick.choices(vocabulary, k=pick.randrange(4 * size))
        for _ in range(pick.randrange(3)):
            at = pick.randrange(len(text) + 1)
            text[at:at] = pick.choice(shared)
        rows.append((i, pick.choice([" ", "\n", "\t "]).join(text)))
    rows += [(100, None), (101, ""), (102, " ".join(["same"] * 5 * size)), (103, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (2, "other words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.without_repeats(df, size=size, anchor=anchor).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in found), key=repr) == brute_repeats(rows, size)
    for r in found:
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]


def test_digests_are_of_the_words_at_their_places():
    data, offsets = words.byte_rows(pa.array(["a b c", "xa\t b\n\nc", "b c", "bc a b c"]))
    begins, ends, _ = words.word_bounds(data, offsets)
    first = np.array([0, 3, 1, 6, 9, 8])
    found = [tuple(x) for x in repeats.digests(data, begins, ends, first, first + [2, 2, 1, 1, 2, 2]).tolist()]
    assert found[0] == found[4] and found[2] == found[3] and len(set(found)) == 4


def test_words_at_row_borders():
    data, offsets = words.byte_rows(pa.array(["ab", "cd e", None, "", " f\x85g ", "h"]))
    begins, ends, first = words.word_bounds(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(begins, ends, strict=True)] == [b"ab", b"cd", b"e", "f\x85g".encode(), b"h"]
    assert first.tolist() == [0, 1, 3, 3, 3, 4, 5]
    hashes = words.word_hashes(data, begins, ends)
    assert len(np.unique(hashes)) == 5
