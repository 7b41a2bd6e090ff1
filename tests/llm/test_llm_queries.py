"""Every query of the llm folder against its SQL twin; each operator on empty, null, repeated and clashing input."""

import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline  # noqa: E402
from vigil.llm import decontam, exact, language, licences, near, pieces, preference, repeats, urls, warc  # noqa: E402
from vigil.llm.queries import ORACLE, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, engine, name):
    frame = QUERIES[name](spark, SMALL)
    relation = engine.execute(ORACLE[name])
    columns = [c[0] for c in relation.description]
    assert ordered(frame.columns, frame.collect()) == ordered(columns, relation.fetchall())


def test_operators_and_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]


LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", None, 0),
    (3, "   \n\t ", "en", "a", 3),
    (4, "12 34 --", "de", "a", 8),
    (5, "one two three four five six seven", "en", None, 30),
    (5, "one two three four five six seven", "en", None, 30),
    (6, "one two three four five six seven", "en", "b", 30),
    (None, "one two three four five six seven", "en", "b", 30),
    (None, None, None, None, None),
    (7, LONG, "en", "b", len(LONG)),
    (8, LONG + " tail", None, "b", len(LONG)),
    (9, "漢字 \u2581 😀 naïve\r\n", "fr", "b", 10),
]

OPERATORS = {
    "exact": exact.exact_dedup,
    "near": near.near_duplicates,
    "repeats": repeats.without_repeats,
    "licences": licences.licences,
    "pieces": lambda df: pieces.decode(pieces.encode(df)),
    "language": lambda df: language.identify(df, language.train(df)),
    "words": lambda df: language.label_words(df, language.train(df)),
    "pages": lambda df: urls.judged(df, "doc_id", "text"),
    "records": lambda df: warc.page_records(df, "doc_id", "source", "text"),
}
FILTERS = {
    "exact": exact.kept_rows,
    "near": near.kept_rows,
    "language": language.accepted,
    "decontam": lambda df: decontam.clean_rows(df, df.sparkSession.createDataFrame([(1, "x")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, name):
    run = OPERATORS[name]
    docs = spark.createDataFrame(ODD, DOCS)
    assert run(docs).count() == len(ODD)
    assert run(docs.limit(0)).count() == 0
    clash = docs
    for c in ("id", "key", "kept", "keep", "size", "n", "rep", "band", "parts", "sha", "k1", "h0", "__id", "row", "bytes", "component_id"):
        clash = clash.withColumn(c, F.lit("x"))
    plain, other = run(docs), run(clash)
    assert ordered(plain.columns, plain.collect()) == ordered(other.columns, other.collect())


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_columns(spark, name):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("__id", F.lit(1)).withColumn("row", F.lit("r")).withColumn("kept", F.lit(True))
    out = FILTERS[name](docs)
    assert out.columns == docs.columns
    assert 0 < out.count() <= len(ODD)
    assert FILTERS[name](docs.limit(0)).count() == 0


def test_pipeline_stages_keep_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, frame, SMALL)
        assert kept.columns == docs.columns
        frame = spark.createDataFrame(kept.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, frame, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert {r["doc_id"]: r["text"] for r in last} == texts
    assert ordered(["doc_id"], [(r["doc_id"],) for r in corpus_pipeline.run(spark, SMALL).collect()]) == ordered(["doc_id"], [(i,) for i in texts])


def test_pipeline_against_brute_force(spark):
    """Language by the model itself; the other stages by loops over all texts."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r["doc_id"]: r for r in language.identify(frame, language.train(frame)).collect()}
    rows = {d[0]: d[1] for d in docs if found[d[0]]["lang_pred"] != "und" and found[d[0]]["score"] >= language.LEAST_SCORE}
    by_text: dict[str, int] = {}
    for i, t in rows.items():
        by_text[t] = max(i, by_text.get(t, i))
    kept = {i: t for t, i in by_text.items()}
    sets = {}
    for i, t in kept.items():
        w = [x.lower() for x in t.encode().split()]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in kept}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(kept)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    kept = {i: kept[i] for i in ids if find(i) == i}
    items = [decontam.normalised([r["text"]])[0][:-1] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items = ["".join(map(chr, p)).strip() for p in items]
    plain = {i: "".join(map(chr, decontam.normalised([t])[0][:-1])) for i, t in kept.items()}
    exact_hits = {i for i, t in plain.items() if any(x in t for x in items)}
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == set(kept) - exact_hits
