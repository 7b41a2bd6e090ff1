"""Point-in-time history: what was known about a user before each event.

Every step takes a ``Series`` keyed by user (or by user and type) and adds columns. Values only use earlier events.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.columns import DAY, DEFAULT_TYPE_WINDOW, HOUR, TYPE_WINDOWS
from vigil.operators.series import BLOCK, ByKey, Running, Series, by_key, cut_into_blocks, in_one_order

USER = ("user_id",)
USER_TYPE = ("user_id", "event_type")
CLEAN_SERIES = ("user_id", "event_type", "clean")


@dataclass(frozen=True)
class Tuning:
    """Everything that can be tuned, with the values of a live system."""

    history_ttl: int = 72 * HOUR
    set_ttl: int = 14 * DAY
    ema_ttl: int = 30 * DAY
    alpha: float = 0.3
    ema_k: float = 2.5
    ema_k_small: float = 4.0
    min_total_user: int = 20
    min_total_global: int = 20
    type_windows: dict[str, int] = field(default_factory=lambda: dict(TYPE_WINDOWS))
    default_type_window: int = DEFAULT_TYPE_WINDOW
    missing_hour: str = "error"

    def scaled_windows(self, factor: int) -> Tuning:
        return replace(
            self,
            type_windows={t: w * factor for t, w in self.type_windows.items()},
            default_type_window=self.default_type_window * factor,
        )


def users(events: DataFrame, limit: int | None = None) -> ByKey:
    return by_key(events, USER, limit=limit).apply(lambda s: s.colocate())


# --- the last events of a user ----------------------------------------------------------------------------------


def previous_events(series: Series, tuning: Tuning = Tuning()) -> Series:
    """The two events before the current one and whether they are still visible.

    An event leaves the history ``history_ttl`` seconds after it when another event of the user is stored, and the
    whole history goes when nothing was stored for that long. A transition is recorded only if all three events lie
    within one ``history_ttl``.
    """
    ttl = tuning.history_ttl
    visible_1 = F.coalesce(F.col("sec") - F.col("sec_1") < ttl, F.lit(False))
    visible_2 = visible_1 & F.coalesce(F.col("sec_1") - F.col("sec_2") < ttl, F.lit(False))
    recorded = F.coalesce(F.col("sec") - F.col("sec_2") < ttl, F.lit(False))
    return series.lag(["sec", "event_type"], 2).with_columns(
        {"visible_1": visible_1, "visible_2": visible_2, "recorded": recorded.cast("long")}
    )


def set_epochs(series: Series, tuning: Tuning = Tuning()) -> Series:
    """Number of whole-set expiries of the user so far.

    Any write restarts the clock of all value sets and of the hour histogram, so they only expire together, after a
    gap of ``set_ttl`` between two events of the user. Needs ``previous_events``.
    """
    expired = F.coalesce(F.col("sec") - F.col("sec_1") >= tuning.set_ttl, F.lit(False)).cast("long")
    return (
        series.with_columns({"_expired": expired})
        .running(Running("_epochs", "sum", F.col("_expired")))
        .transform(lambda df: df.withColumn("epoch", F.col("_epochs") + F.col("_expired")).drop("_epochs", "_expired"))
    )


def _seen(columns: tuple[str, ...] = ("ip", "user_agent", "country")) -> list[Running]:
    return [Running(f"seen_{c}", "sum", F.lit(1), ("epoch", c)) for c in columns]


def seen_before(series: Series, *columns: str) -> Series:
    """``seen_<column>``: how often the user had this value since the last expiry. Needs ``set_epochs``."""
    return series.running(*(_seen(columns) if columns else _seen()))


# --- transitions ------------------------------------------------------------------------------------------------

FIRST, SECOND = "event_type_1", "event_type_2"


def _transition_counts(prefix: str) -> list[Running]:
    recorded = F.col("recorded")
    return [
        Running(f"{prefix}_total_1", "sum", recorded, (FIRST,)),
        Running(f"{prefix}_count_1", "sum", recorded, (FIRST, "event_type")),
        Running(f"{prefix}_total_2", "sum", recorded, (FIRST, SECOND)),
        Running(f"{prefix}_count_2", "sum", recorded, (FIRST, SECOND, "event_type")),
    ]


def user_transitions(series: Series) -> Series:
    """Transitions of the user recorded before the event, from its last one and two types. Needs ``previous_events``."""
    return series.running(*_transition_counts("user"))


def global_transitions(
    df: DataFrame, limit: int | None = None, rows: int | None = None, keep: bool = False
) -> DataFrame:
    """The same over all users, in the order of all events.

    There are only a handful of transitions, so a window per transition would be a few huge tasks: beyond one block
    of rows the events are cut into blocks of consecutive events and only block totals travel between them.
    """
    series = in_one_order(df, limit=limit, rows=rows).colocate(FIRST)
    return series.running(*_transition_counts("global"), keep=keep).df.drop(BLOCK)


def transition_histogram(events: DataFrame, tuning: Tuning = Tuning(), limit: int | None = None) -> DataFrame:
    """Final counts of all recorded transitions: first order (``prev2`` null) and second order."""
    recorded = (
        users(events.select("user_id", "sec", "seq", "event_type"), limit)
        .apply(lambda s: previous_events(s, tuning))
        .frame()
        .where(F.col("recorded") == 1)
    )
    second = recorded.groupBy(
        F.col(SECOND).alias("prev2"), F.col(FIRST).alias("prev1"), F.col("event_type").alias("cur")
    ).agg(F.count(F.lit(1)).alias("n"))
    # Both orders come from one count: grouping the second-order histogram is cheap.
    orders = F.explode(F.array(F.lit(1), F.lit(2)))
    return (
        second.withColumn("markov_order", orders)
        .withColumn("prev2", F.when(F.col("markov_order") == 2, F.col("prev2")))
        .groupBy("markov_order", "prev2", "prev1", "cur")
        .agg(F.sum("n").alias("n"))
    )


# --- frequency --------------------------------------------------------------------------------------------------


def type_window(tuning: Tuning) -> tuple[Column, list[int]]:
    """Window seconds of the row's type, and all lengths there are."""
    chain = reduce(
        lambda c, item: c.when(F.col("event_type") == item[0], F.lit(item[1])),
        tuning.type_windows.items(),
        F.when(F.lit(False), F.lit(0)),
    )
    lengths = sorted({*tuning.type_windows.values(), tuning.default_type_window})
    return chain.otherwise(F.lit(tuning.default_type_window)).cast("long"), lengths


def count_in_window(series: Series, span: Column, lengths: Sequence[int], name: str = "count_before") -> Series:
    """Earlier rows of the key that are at most ``span`` seconds old, both ends included.

    ``span`` is constant within a key and one of ``lengths``. The count is a rank minus the number of rows that are
    already too old; both are frames that only grow, so the cost is linear however dense the events are. Each length has
    a frame of its own over the same sort.
    """
    span = span.cast("long")
    if not series.cut:
        rank = Window.partitionBy(*series.key).orderBy("sec", "seq")
        by_time = Window.partitionBy(*series.key).orderBy("sec")
        older = {
            f"_older_{n}": F.count(F.lit(1)).over(by_time.rangeBetween(Window.unboundedPreceding, -(n + 1))) for n in lengths
        }
        mine = F.coalesce(*(F.when(span == n, F.col(f"_older_{n}")) for n in lengths))
        counted = series.df.withColumns({"_rank": F.row_number().over(rank), **older}).withColumn(
            name, (F.col("_rank") - 1 - mine).cast("long")
        )
        return series.transform(lambda _: counted.drop("_rank", *older))
    # In blocks the rows that are too old may lie in any earlier block. Each event therefore leaves a second row
    # behind at the moment it gets too old, and the count is a running sum of arrivals and departures.
    rows = series.df.drop(BLOCK)
    arrivals = rows.withColumns({"_at": F.col("sec"), "_turn": F.lit(1), "_step": F.lit(1)})
    departures = rows.select(
        *series.key,
        "seq",
        (F.col("sec") + span + 1).alias("_at"),
        F.lit(0).alias("_turn"),
        F.lit(-1).alias("_step"),
    )
    both = cut_into_blocks(
        arrivals.unionByName(departures, allowMissingColumns=True),
        series.key,
        ("_at", "_turn", "seq"),
        2 * series.blocks,
    ).running(Running(name, "sum", F.col("_step")))
    counted = both.df.where(F.col("_turn") == 1).drop("_at", "_turn", "_step")
    return replace(series, df=counted, blocks=2 * series.blocks)


def type_counts(series: Series, tuning: Tuning = Tuning(), name: str = "type_count") -> Series:
    """Earlier events of the same user and type within that type's window. The result is keyed by user and type."""
    span, lengths = type_window(tuning)
    return count_in_window(series.rekey(USER_TYPE), span, lengths, name)


def moving_averages(series: Series, value: str, tuning: Tuning = Tuning()) -> Series:
    """Exponential moving average ``ema`` of ``value`` and of its deviation, ``sigma``, within the key.

    ``ema_n = a x_n + (1-a) ema_(n-1)``, seeded with the first value and reset after ``ema_ttl`` idle seconds. The
    rows of a series are taken in chunks: inside a chunk the average is a running sum of terms weighted by ``(1-a)^-j``,
    and the chunk before enters with its closing value. A chunk is as long as it takes ``(1-a)^n`` to fall to 1e-140, for
    any ``a``: weights and sums stay far inside a double, and what lies two chunks back is far below its last digit. With
    ``a = 1`` every average is its own value.
    """
    keep = 1.0 - tuning.alpha
    if not 0 < tuning.alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    chunk = ceil(140 * log(10) / -log(keep)) if keep else 1
    idle = F.coalesce(F.col("_upd") - F.col("_upd_1") >= tuning.ema_ttl, F.lit(False)).cast("long")
    series = series.with_columns({"_upd": F.col("sec")}).lag(["_upd"], 1).with_columns({"_idle": idle})
    series = series.running(Running("_resets", "sum", F.col("_idle"))).with_columns(
        {"_run": F.col("_resets") + F.col("_idle")}
    )
    series = series.running(Running("_pos", "sum", F.lit(1), ("_run",))).with_columns(
        {"_chunk": F.floor(F.col("_pos") / chunk), "_j": F.col("_pos") % chunk}
    )

    def fold(s: Series, x: Column, name: str) -> Series:
        if not keep:
            return s.with_columns({name: x})
        weight = F.when(F.col("_pos") == 0, 1.0).otherwise(tuning.alpha)
        s = s.with_columns({"_term": x * weight * F.pow(F.lit(keep), -F.col("_j"))})
        s = s.running(Running("_sum", "sum", F.col("_term"), ("_run", "_chunk")))
        s = s.with_columns({"_open": (F.col("_sum") + F.col("_term")) * F.pow(F.lit(keep), F.col("_j"))})
        closing = F.when(F.col("_j") == chunk - 1, F.col("_open"))
        s = s.running(Running("_closed", "last", closing, ("_run",)))
        carried = F.coalesce(F.col("_closed"), F.lit(0.0)) * F.pow(F.lit(keep), F.col("_j") + 1)
        return s.transform(
            lambda df: df.withColumn(name, F.col("_open") + carried).drop("_term", "_sum", "_open", "_closed")
        )

    series = fold(series, F.col(value).cast("double"), "ema")
    series = series.with_columns({"deviation": F.abs(F.col(value) - F.col("ema"))})
    series = fold(series, F.col("deviation"), "sigma")
    return series.transform(
        lambda df: df.drop("_upd", "_upd_1", "_idle", "_resets", "_run", "_pos", "_chunk", "_j")
    )


# --- hours ------------------------------------------------------------------------------------------------------


def _hours() -> list[Running]:
    return [
        Running("hour_count", "sum", F.lit(1), ("epoch", "hour")),
        Running("_events", "sum", F.lit(1), ("epoch",)),
    ]


def _hour_spread(series: Series) -> Series:
    """Adding an event to an hour that already has ``r - 1`` raises the sum of squares by ``2r - 1``."""
    series = series.running(Running("_squares", "sum", 2 * F.col("hour_count") + 1, ("epoch",)))
    mean = F.col("_events") / 24.0
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("_squares") / 24.0 - mean * mean))
    return series.transform(lambda df: df.withColumn("hour_stddev", spread).drop("_events", "_squares"))


def hour_counts(series: Series) -> Series:
    """Earlier events in the same hour of day, and the deviation of the 24 hourly counts. Needs ``set_epochs``."""
    return _hour_spread(series.running(*_hours()))


def all_counts(series: Series) -> Series:
    """``seen_before``, ``user_transitions`` and ``hour_counts`` in one step. Needs ``set_epochs``."""
    return _hour_spread(series.running(*_seen(), *_transition_counts("user"), *_hours()))
