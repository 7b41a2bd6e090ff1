"""Preference pairs: shared turns as one prompt, and two completions with loss masks.

The prompt is the longest run of equal turns at the start of both conversations, cut back so that each keeps at least one
turn. It is rendered once; what follows in either conversation is rendered as its completion. The mask of a completion is a
list of character spans: the text and end mark of the assistant's turns. Texts cannot forge a turn: ``<|`` in a role or text
is rendered as ``< |``.

Defined results: a null role or text counts as empty; turns are ordered by turn, role and text, so ties and repeated rows have
one order; rows without a conversation id belong to none; pairs of equal conversations have the status ``equal``, pairs
without turns on one side ``incomplete``, and the texts and masks of both are empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"


def conversations(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: id and its turns in order."""
    bare = df.select(F.col(id).alias("id"), F.col(turn).alias("turn"), *(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))))
    turns = bare.filter("id IS NOT NULL").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return turns.select(F.col("id").alias(id), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(turn["role"]), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column) -> Column:
    """Character spans of the assistant's words and end marks in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(_body(t))
        own = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def shared_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix, at most one less than the shorter conversation."""
    most = F.greatest(F.lit(0), F.least(F.size(a), F.size(b)) - 1)
    differs = F.exists(F.sequence(F.lit(1), most), lambda i: F.element_at(a, i) != F.element_at(b, i))
    first = F.array_position(F.transform(F.sequence(F.lit(1), most), lambda i: F.element_at(a, i) != F.element_at(b, i)), True)
    return F.when(most == 0, F.lit(0)).when(differs, first.cast("int") - 1).otherwise(most)


def formatted(pairs: DataFrame, id: str = "pair_id", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """One row per pair: id, status, ``n_prompt_turns``, prompt, and text and mask of both completions."""
    base = pairs.select(F.col(id).alias("id"), *(F.coalesce(F.col(c).cast(TURNS), F.array().cast(TURNS)).alias(n) for c, n in ((chosen, "a"), (rejected, "b"))))
    status = F.when((F.size("a") == 0) | (F.size("b") == 0), "incomplete").when(F.col("a") == F.col("b"), "equal").otherwise("pair")
    pair, none = F.col("status") == "pair", F.array().cast(TURNS)
    cut = base.withColumn("status", status).withColumn("n", F.when(pair, shared_turns(F.col("a"), F.col("b"))).otherwise(0))
    cut = cut.select("id", "status", "n", *(F.when(pair, F.col(c)).otherwise(none).alias(c) for c in "ab"))
    rest = {c: F.slice(c, F.col("n") + 1, F.size(c)) for c in "ab"}
    parts = cut.select("id", "status", "n", F.slice("a", F.lit(1), F.col("n")).alias("p"), *(x.alias(c) for c, x in rest.items()))
    return parts.select(
        F.col("id").alias(id), "status", F.col("n").alias("n_prompt_turns"), rendered(F.col("p")).alias("prompt"),
        rendered(F.col("a")).alias("chosen"), mask(F.col("a")).alias("chosen_mask"),
        rendered(F.col("b")).alias("rejected"), mask(F.col("b")).alias("rejected_mask"),
    )


def derived_pairs(convs: DataFrame, id: str = "conv_id") -> DataFrame:
    """A pair of every conversation: it is chosen; rejected is what comes of it when, from one of the assistant's turns on, the
    conversation with the next id goes on from its own first assistant turn. The turn is number ``id`` modulo their count."""
    answers = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["role"] == "assistant")
    own = convs.select(F.col(id).alias("id"), "turns", answers.alias("at"))
    own = own.withColumn("cut", F.when(F.size("at") > 0, F.element_at("at", (F.pmod("id", F.size("at")) + 1).cast("int"))))
    tail = convs.select((F.col(id) - 1).alias("id"), F.col("turns").alias("next"), F.expr("filter(sequence(1, size(turns)), i -> turns[i - 1].role = 'assistant')").alias("next_at"))
    joined = own.join(tail.filter(F.size("next_at") > 0), "id", "left")
    rejected = F.concat(F.slice("turns", F.lit(1), F.col("cut") - 1), F.slice("next", F.col("next_at")[0], F.size("next")))
    return joined.select(F.col("id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))


def op1_preference_format(spark, folder):
    found = formatted(derived_pairs(conversations(spark.read.parquet(f"{folder}/conversations.parquet"))))

    def masked(column: str) -> Column:
        return F.aggregate(column, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])

    return found.select(
        F.col("pair_id").alias("conv_id"), "status", "n_prompt_turns",
        *(F.sha2(c, 256).alias(f"{c}_sha256") for c in ("prompt", "chosen", "rejected")),
        *(masked(f"{c}_mask").alias(f"{c}_masked") for c in ("chosen", "rejected")),
    )


QUERIES = {"op1_preference_format": op1_preference_format}
ORACLE = {
    "op1_preference_format": """
        WITH c AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS t
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), k AS (
            SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS at FROM c
        ), j AS (
            SELECT a.conv_id, a.t AS a, CASE WHEN len(a.at) > 0 AND b.conv_id IS NOT NULL
                   THEN list_concat(a.t[:a.at[a.conv_id % len(a.at) + 1] - 1], b.t[b.at[1]:]) ELSE [] END AS b
            FROM k a LEFT JOIN k b ON b.conv_id = a.conv_id + 1 AND len(b.at) > 0
        ), s AS (
            SELECT *, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 'incomplete' WHEN a = b THEN 'equal' ELSE 'pair' END AS status,
                   least(len(a), len(b)) - 1 AS most FROM j
        ), n AS (
            SELECT *, CASE WHEN status = 'pair' THEN coalesce(list_min(list_filter(range(1, most + 1), lambda i: a[i] <> b[i])) - 1, most) ELSE 0 END AS n FROM s
        ), r AS (
            SELECT conv_id, status, n, a[:n] AS p, CASE WHEN status = 'pair' THEN a[n + 1:] ELSE [] END AS x,
                   CASE WHEN status = 'pair' THEN b[n + 1:] ELSE [] END AS y FROM n
        ), m AS (
            SELECT conv_id, status, n,
                   list_transform([p, x, y], lambda q: coalesce(array_to_string(list_transform(q, lambda t:
                       '<|im_start|>' || replace(t.role, '<|', '< |') || chr(10) || replace(t.text, '<|', '< |') || '<|im_end|>' || chr(10)), ''), '')) AS texts,
                   list_transform([x, y], lambda q: coalesce(list_sum(list_transform(list_filter(q, lambda t: t.role = 'assistant'),
                       lambda t: length(replace(t.text, '<|', '< |')) + 11)), 0)) AS masked FROM r
        )
        SELECT conv_id, status, n::INTEGER AS n_prompt_turns, sha256(texts[1]) AS prompt_sha256, sha256(texts[2]) AS chosen_sha256,
               sha256(texts[3]) AS rejected_sha256, masked[1]::BIGINT AS chosen_masked, masked[2]::BIGINT AS rejected_masked FROM m
    """
}
