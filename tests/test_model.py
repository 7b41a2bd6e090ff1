from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.operators import features as feat
from vigil.operators import training as tr
from vigil.operators.model import Autoencoder, loss_column, ml_verdicts, reconstruct, score
from vigil.schemas import FEATURES
from vigil.sources.artifacts import load_artifacts, load_state, save_artifacts, save_state

AS_OF = datetime(2024, 1, 31)


def session(spark, n, sid="s"):
    data = [(sid, 1, f"ip{i % 2}", "PL", "ua", "login" if i else None, i, i, i % 24) for i in range(n)]
    df = spark.createDataFrame(
        data,
        "session_id STRING, user_id LONG, ip STRING, country STRING, user_agent STRING, event_type STRING, "
        "sec LONG, seq LONG, hour INT",
    )
    return df.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz"))


@pytest.mark.parametrize("n,batches", [(4, 0), (5, 1), (11, 2)])
@pytest.mark.parametrize("limit", [None, 3])
def test_only_full_batches(spark, n, batches, limit):
    got = feat.ml_batch_features(session(spark, n), limit=limit)
    assert got.count() == batches


def test_batch_takes_user_and_time_of_its_last_event(spark):
    got = feat.ml_batch_features(session(spark, 10)).orderBy("batch").collect()
    assert [r["sec"] for r in got] == [4, 9] and got[0]["unique_events"] == 1 and got[0]["unique_ips"] == 2


def test_no_session_no_batch(spark):
    assert feat.ml_batch_features(session(spark, 10, "")).count() == 0
    assert feat.session_features(session(spark, 10, "")).count() == 1
    assert feat.session_features(session(spark, 10, ""), keep_empty=False).count() == 0


def test_null_types_count_as_a_type(spark):
    row = feat.session_features(session(spark, 3)).first()
    assert (row["event_count"], row["unique_events"]) == (3, 2)


@pytest.mark.parametrize("limit", [None, 4])
def test_long_sessions_are_lists_in_parts(spark, limit):
    got = feat.session_event_sequence(session(spark, 11), part_size=4, limit=limit).orderBy("part").collect()
    assert [len(r["event_sequence"]) for r in got] == [4, 4, 3]
    assert got[0]["event_sequence"][0] is None and got[2]["event_sequence"] == ["login"] * 3


def test_scaler_uses_population_deviation(spark, events):
    frame = feat.session_features(events)
    scaler = feat.Scaler.fit(frame)
    x = frame.select(*FEATURES).toPandas().to_numpy(dtype=float)
    assert np.allclose(scaler.mean, x.mean(axis=0))
    std = x.std(axis=0)
    assert np.allclose(scaler.scale, np.where(std == 0, 1, std))
    with pytest.raises(ValueError):
        feat.scaler_transform(frame, None)


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    model, x = Autoencoder.seeded(1, 8), rng.normal(size=(6, 8))
    loss, gradient = model.loss_and_gradient(x)
    flat = model.flat()
    for i in rng.choice(len(flat), 25, replace=False):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        up = Autoencoder.from_flat(flat + step, 8).loss_and_gradient(x)[0]
        down = Autoencoder.from_flat(flat - step, 8).loss_and_gradient(x)[0]
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_scores_equal_numpy(spark, events):
    frame = feat.session_features(events)
    scaler, model = feat.Scaler.fit(frame), Autoencoder.seeded(2)
    got = score(frame, model, scaler).orderBy("session_id").toPandas()
    x = (got[list(FEATURES)].to_numpy(dtype=float) - scaler.mean) / scaler.scale
    assert np.allclose(got["score"], ((model.reconstruct(x) - x) ** 2).mean(axis=1))
    scaled = feat.scaler_transform(frame, scaler)
    rebuilt = reconstruct(scaled, model).orderBy("session_id").toPandas()
    assert np.allclose(np.stack(rebuilt["reconstruction"]), model.reconstruct(x))
    single = scaled.withColumn("loss", loss_column(model, single_precision=True)).orderBy("session_id").toPandas()
    assert np.allclose(single["loss"], got["score"], rtol=1e-4)


def test_threshold_is_multiplied(spark, events):
    frame = feat.session_features(events)
    got = ml_verdicts(feat.ml_batch_features(events), Autoencoder.seeded(2), feat.Scaler.fit(frame), 0.1)
    assert got.where("abs(threshold - 1.0) > 1e-12").count() == 0
    assert got.where("anomaly <> (score > threshold)").count() == 0


def test_training_improves_and_repeats(spark, events, tmp_path):
    config = tr.TrainingConfig(epochs=6, batch_size=16, workers=2, learning_rate=0.01)
    frame = feat.session_features(events)
    scaled = feat.scaler_transform(frame, feat.Scaler.fit(frame))
    first = tr.train(scaled, tr.TrainingConfig(epochs=1, batch_size=16, workers=2, learning_rate=0.01))[1]
    model, last = tr.train(scaled, config)
    again, _ = tr.train(scaled, config)
    assert last < first and np.allclose(model.flat(), again.flat())
    with pytest.raises(ValueError):
        tr.train(scaled.where("false"), config)


def test_fit_save_load_and_score(spark, events, tmp_path):
    trained = tr.fit(events, tr.TrainingConfig(epochs=2, batch_size=8, workers=2))
    save_artifacts(spark, trained, f"file://{tmp_path}/model")
    loaded = load_artifacts(spark, f"file://{tmp_path}/model")
    batches = feat.ml_batch_features(events)
    scored = [ml_verdicts(batches, m.model, m.scaler, m.metrics["threshold"]) for m in (trained, loaded)]
    assert scored[0].count() > 0 and rows(scored[0]) == rows(scored[1])
    assert np.array_equal(loaded.model.flat(), trained.model.flat())
    assert loaded.scaler == trained.scaler and loaded.metrics == trained.metrics
    assert trained.metrics["threshold"] > 0


def test_batches_of_losses(spark):
    losses = spark.range(600).select(F.col("id").cast("string").alias("session_id"), F.col("id").cast("double").alias("loss"))
    got = tr.batch_losses(losses, 256)
    assert sorted(r["rows"] for r in got.collect()) == [88, 256, 256]
    result = tr.evaluate(losses).first()
    means = sorted(r["loss"] for r in got.collect())
    assert result["threshold"] == pytest.approx(np.percentile(means, 95))
    assert result["test_loss"] == pytest.approx(np.mean(means))


def test_batches_have_one_size_beyond_a_block(spark):
    losses = spark.range(1000).select(F.col("id").cast("string").alias("session_id"), F.col("id").cast("double").alias("loss"))
    whole = tr.batch_losses(losses, 256)
    cut = tr.batch_losses(losses, 256, limit=150)
    assert sorted(r["rows"] for r in cut.collect()) == [232, 256, 256, 256]
    assert rows(cut) == rows(whole)


def test_training_batches_cross_frames():
    import pandas as pd

    frames = [pd.DataFrame(np.full((n, 8), n, float), columns=list(FEATURES)) for n in (10, 3, 0, 20)]
    sizes = [len(x) for x in tr._batches(iter(frames), 8, np.random.default_rng(0))]
    assert sizes == [8, 8, 8, 8, 1]


def test_one_worker_equals_a_plain_loop(spark, events):
    config = tr.TrainingConfig(epochs=1, batch_size=16, workers=1)
    frame = feat.session_features(events)
    scaled = feat.scaler_transform(frame, feat.Scaler.fit(frame))
    model, loss = tr.train(scaled, config)
    x = scaled.orderBy("session_id").toPandas()[list(FEATURES)].to_numpy(float)
    x = x[np.random.default_rng([config.seed, 0, 0]).permutation(len(x))]
    w = Autoencoder.seeded(config.seed, config.hidden).flat()
    m, v, losses = np.zeros_like(w), np.zeros_like(w), []
    for t, at in enumerate(range(0, len(x), 16), 1):
        value, g = Autoencoder.from_flat(w, config.hidden).loss_and_gradient(x[at : at + 16])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - config.learning_rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        losses.append(value)
    assert np.allclose(model.flat(), w) and loss == pytest.approx(np.mean(losses))


@pytest.mark.parametrize("tasks,limit", [(2, None), (16, None), (16, 30)])
def test_synchronous_steps_equal_a_plain_loop(spark, events, tasks, limit):
    config = tr.TrainingConfig(epochs=2, batch_size=20, learning_rate=0.01)
    frame = feat.session_features(events)
    scaled = feat.scaler_transform(frame, feat.Scaler.fit(frame))
    order = F.xxhash64("session_id", F.lit(config.seed))
    x = scaled.orderBy(order, "session_id").toPandas()[list(FEATURES)].to_numpy(float)
    w = Autoencoder.seeded(config.seed, config.hidden).flat()
    m, v, t, losses = np.zeros_like(w), np.zeros_like(w), 0, []
    for _ in range(config.epochs):
        losses = []
        for at in range(0, len(x), 20):
            value, g = Autoencoder.from_flat(w, config.hidden).loss_and_gradient(x[at : at + 20])
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
            w = w - config.learning_rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            losses.append(value)
    model, loss = tr.train_in_steps(scaled.repartition(tasks), config, limit=limit)
    assert len(x) > 60
    assert np.allclose(model.flat(), w, atol=1e-9) and loss == pytest.approx(np.mean(losses))
    with pytest.raises(ValueError):
        tr.train_in_steps(scaled.where("false"), config)


def test_gradient_is_that_of_any_number_of_tasks(spark, events):
    frame = feat.session_features(events)
    scaled = feat.scaler_transform(frame, feat.Scaler.fit(frame))
    model = Autoencoder.seeded(4)
    loss, want = model.loss_and_gradient(scaled.toPandas()[list(FEATURES)].to_numpy(float))
    for tasks in (1, 3, 16):
        got = [r["value"] for r in sorted(tr.loss_gradient(scaled.repartition(tasks), model).collect())]
        assert np.allclose(got[:-1], want, atol=1e-12) and got[-1] == pytest.approx(loss)


def test_workers_follow_from_the_rows(spark, events):
    frame = feat.session_features(events)
    scaled = feat.scaler_transform(frame, feat.Scaler.fit(frame))
    named = tr.train(scaled, tr.TrainingConfig(epochs=1, workers=1))[0]
    assert np.array_equal(tr.train(scaled, tr.TrainingConfig(epochs=1))[0].flat(), named.flat())
    many = tr.TrainingConfig(epochs=1, rows_per_worker=-(-scaled.count() // 3))
    assert np.array_equal(tr.train(scaled, many)[0].flat(), tr.train(scaled, tr.TrainingConfig(epochs=1, workers=3))[0].flat())


def test_split_is_repeatable(events):
    frame = feat.session_features(events)
    assert rows(tr.train_test_split(frame)) == rows(tr.train_test_split(frame.repartition(3)))


def test_safe_max(spark):
    df = spark.createDataFrame([(None,)], "a LONG")
    row = df.agg(tr.safe_max(df, "a").alias("a"), tr.safe_max(df, "b").alias("b")).first()
    assert row["a"] is None and row["b"] is None


def test_retrain_decision(events):
    def decide(last_id, trained_at, **limits):
        state = tr.TrainingState(last_event_id=last_id, trained_at=trained_at)
        row = tr.retrain_decision(events, state, AS_OF, **limits).first()
        return row["retrain"], row["reason"]

    fresh = (AS_OF - timedelta(hours=1)).isoformat()
    assert decide(0, fresh, min_new_events=999) == (True, "volume: 999 events to learn from")
    assert decide(500, fresh) == (False, "")
    old = (AS_OF - timedelta(hours=6)).isoformat()
    assert decide(500, old) == (True, "age: the model is due")
    assert decide(500, None)[0] and decide(500, "never")[0]
    assert decide(500, None, max_hours=None) == (False, "")


def test_retrainer_saves_its_state(spark, events, tmp_path):
    path = f"file://{tmp_path}/state"
    calls = []

    def train(df):
        calls.append(df.count())
        return tr.TrainedModel(Autoencoder.seeded(), feat.Scaler((0.0,) * 8, (1.0,) * 8), {"threshold": 1.0})

    def retrainer():
        return tr.Retrainer(train, lambda: load_state(spark, path), lambda s: save_state(spark, s, path), min_new_events=10)

    assert retrainer().poll(events.where("false"), AS_OF) is None
    assert retrainer().poll(events, AS_OF) is not None
    assert retrainer().poll(events, AS_OF) is None and calls == [1000]
    assert load_state(spark, path).last_event_id == 999
    (tmp_path / "state" / "cut.json").write_text("{broken")
    assert load_state(spark, path).last_event_id == 999
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.json").write_text("{broken")
    assert load_state(spark, f"{tmp_path}/bad") == tr.TrainingState() == load_state(spark, f"{tmp_path}/none")
