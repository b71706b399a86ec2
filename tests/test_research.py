import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.functions import arma
from candlewick.operators import arima, iforest
from candlewick.operators.arima import arima_forecast
from candlewick.operators.events import event_study, event_windows, rejected_events
from candlewick.operators.features import (
    FEATURE_COLUMNS,
    inject_shock,
    log_returns,
    ohlcv_features,
)
from candlewick.operators.forecast import (
    forecast_eval,
    forecast_metrics,
    naive_forecast,
    short_series,
)
from candlewick.operators.quantile import exact_quantile, exact_quantiles
from candlewick.plans import research

DAY = 86_400_000


def walk(n, seed, symbol="A", spike=False):
    """A random-walk series; with `spike` the last bar jumps 35 % on 20 times the volume."""
    rng = np.random.default_rng(seed)
    close = 100 * np.cumprod(1 + rng.normal(0, 0.015, n))
    volume = rng.lognormal(9, 0.25, n)
    open_ = np.concatenate([[100.0], close[:-1]])
    if spike:
        close[-1] = open_[-1] * 1.35
        volume[-1] *= 20
    high = np.maximum(open_, close) * 1.004
    low = np.minimum(open_, close) * 0.996
    return pd.DataFrame(
        {
            "symbol": symbol,
            "open_time_ms": np.arange(n) * DAY,
            "open": open_,
            "high": high,
            "low": low,
            "close": close,
            "volume": volume,
        }
    )


def bars(spark, *frames):
    return spark.createDataFrame(pd.concat(frames))


def pandas_features(frame):
    frame = frame.copy()
    frame["return_1d"] = frame["close"].pct_change().fillna(0.0)
    frame["log_volume"] = np.log(frame["volume"])
    for source, target in (("log_volume", "volume_z"), ("return_1d", "return_z")):
        rolling = frame[source].rolling(7, min_periods=1)
        frame[target] = ((frame[source] - rolling.mean()) / rolling.std()).fillna(0.0)
    return frame


@pytest.mark.parametrize("daily", [True, False])
def test_features_equal_pandas_per_symbol(spark, daily):
    frames = [walk(40, 1, "A"), walk(25, 2, "B")]
    got = ohlcv_features(bars(spark, *frames), daily=daily).toPandas()
    for frame in frames:
        mine = got[got.symbol == frame.symbol[0]].sort_values("open_time_ms")
        want = pandas_features(frame)
        for name in ("return_1d", "log_volume", "volume_z", "return_z"):
            np.testing.assert_allclose(mine[name], want[name], atol=1e-9)


def test_features_of_degenerate_bars(spark):
    flat = pd.DataFrame(
        {
            "symbol": "A",
            "open_time_ms": np.arange(3) * DAY,
            "open": 0.0,
            "high": 1.0,
            "low": 1.0,
            "close": [0.0, 1.0, 1.0],
            "volume": 0.0,
        }
    )
    rows = ohlcv_features(bars(spark, flat), daily=True).toPandas()
    assert np.isfinite(rows[list(FEATURE_COLUMNS)].to_numpy()).all()
    assert rows["log_volume"].iloc[0] == pytest.approx(np.log(1e-12))


def test_log_returns_drop_the_first_bar_of_each_symbol(spark):
    rows = log_returns(bars(spark, walk(10, 1, "A"), walk(6, 2, "B")), daily=True).toPandas()
    assert len(rows) == 14
    want = np.diff(np.log(walk(10, 1).close))
    got = rows[rows.symbol == "A"].sort_values("open_time_ms").log_return
    np.testing.assert_allclose(got, want)


# --- anomalies


def scored(spark, *frames, **options):
    return research.detect_anomalies(ohlcv_features(bars(spark, *frames), daily=True), **options)


def test_spike_ranks_first_and_is_flagged(spark):
    result = scored(spark, walk(53, 7, spike=True), contamination=0.08, seed=7)
    top = research.top_anomalies(result, 3).collect()
    assert top[0].open_time_ms == 52 * DAY
    assert top[0].is_anomaly and top[0].return_1d > 0.1
    assert research.spike_flagged(result).first()[0]
    report = research.anomaly_report(result, top_k=3).first()
    assert report.top_flags[0].open_time_ms == 52 * DAY
    assert len(report.top_flags) == 3
    assert report.summary.n_rows == 53


def test_clean_series_has_few_flags(spark):
    summary = research.anomaly_summary(scored(spark, walk(53, 7))).first()
    assert summary.anomaly_rate <= 0.15
    assert summary.n_anomalies == round(summary.anomaly_rate * 53)


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "is_anomaly boolean")
    assert tuple(research.anomaly_summary(empty).first()) == (0, 0, 0.0)


def test_samples_are_exact_distinct_and_repeatable(spark):
    features = spark.range(3000).selectExpr("'s' AS symbol", "id AS open_time_ms", "rand(1) AS x")
    features = features.cache()
    args = (["x"], ["symbol", "open_time_ms"], 3000, 20, 64, 5)
    drawn = iforest.tree_samples(features, *args).toPandas()
    assert (drawn.groupby("tree").size() == 64).all() and drawn.tree.nunique() == 20
    assert drawn.groupby("tree").x.nunique().eq(64).all()
    again = iforest.tree_samples(features.repartition(9), *args).toPandas()
    order = ["tree", "rank"]
    pd.testing.assert_frame_equal(
        drawn.sort_values(order, ignore_index=True), again.sort_values(order, ignore_index=True)
    )


def test_large_tables_deal_rows_to_trees(spark):
    rows, trees, sample = 60_000, 10, 32
    features = spark.range(rows).selectExpr("'s' AS symbol", "id AS open_time_ms", "id AS x")
    drawn = iforest.tree_samples(
        features, ["x"], ["symbol", "open_time_ms"], rows, trees, sample, 5
    ).toPandas()
    assert (drawn.groupby("tree").size() == sample).all() and drawn.tree.nunique() == trees
    assert drawn.x.nunique() > 0.9 * trees * sample
    assert abs(drawn.x.mean() / rows - 0.5) < 0.1


def test_forest_scores_an_outlier_lowest(spark):
    rng = np.random.default_rng(0)
    points = pd.DataFrame(rng.normal(size=(500, 2)), columns=["a", "b"])
    points.loc[123] = [9.0, -9.0]
    points["row"] = np.arange(500)
    df = spark.createDataFrame(points)
    forest = iforest.fit_iforest(df, ["a", "b"], ["row"], trees=50, sample=128)
    result = iforest.score_iforest(df, forest, 0.05).toPandas().sort_values("anomaly_score")
    assert result.row.iloc[0] == 123
    assert result.is_anomaly.mean() == pytest.approx(0.05, abs=0.002)


# --- quantiles


@pytest.mark.parametrize("kind", ["spread", "ties", "two", "heavy", "signs"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "spread": rng.normal(size=20_000),
        "ties": rng.integers(0, 5, 20_000).astype(float),
        "two": np.repeat([0.0, 1.0], 10_000),
        "heavy": np.exp(rng.normal(0, 30, 20_000)),
        "signs": np.array([-0.0, 0.0, -1e308, 1e308, -5e-324, 5e-324] * 3),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(4)
    qs = [0.0, 0.003, 0.25, 0.5, 0.77, 0.999, 1.0] if kind != "signs" else [0.0, 0.3, 0.5, 1.0]
    want = np.quantile(values, qs, method="linear")
    got = exact_quantiles(df, "v", qs)
    assert got == pytest.approx(want.tolist(), rel=1e-12)


def test_nan_is_the_largest_value(spark):
    values = [float("nan"), -1.0, None, float("inf"), float("-inf"), 2.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    *finite, high = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0])
    assert finite == [float("-inf"), -1.0, 2.0, float("inf")] and np.isnan(high)


def test_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5) is None


# --- forecasts


def test_metrics_by_hand(spark):
    actual, pred = [10.0, 12.0, 11.0, 11.0], [10.0, 11.0, 13.0, 11.0]
    rows = [("A", "m", i + 1, a, p, False) for i, (a, p) in enumerate(zip(actual, pred))]
    schema = (
        "symbol string, model string, step int, actual double, pred double, fit_failed boolean"
    )
    df = spark.createDataFrame(rows, schema)
    row = forecast_metrics(df).first()
    assert row.mae == pytest.approx(0.75)
    assert row.rmse == pytest.approx(np.sqrt(5 / 4))
    # moves up, down, flat; predicted up, up, flat
    assert row.directional_accuracy == pytest.approx(2 / 3)
    assert forecast_metrics(df.limit(1)).first().directional_accuracy == 0.0


def test_naive_repeats_the_last_close(spark):
    frame = walk(30, 4)
    rows = naive_forecast(bars(spark, frame), 8).orderBy("step").collect()
    np.testing.assert_allclose([r.actual for r in rows], frame.close[-8:])
    np.testing.assert_allclose([r.pred for r in rows], frame.close[-9:-1])


def test_evaluation_compares_both_models_and_skips_short_series(spark):
    df = bars(spark, walk(63, 1, "A"), walk(13, 2, "short"), walk(14, 3, "enough"))
    predictions = naive_forecast(df, 8).unionByName(arima_forecast(df, 8).drop("converged"))
    rows = {row.symbol: row for row in forecast_eval(df, predictions, 8).collect()}
    assert set(rows) == {"A", "enough"}
    row = rows["A"]
    assert (row.n_train, row.n_holdout) == (55, 8)
    assert row.naive_mae >= 0 and row.arima_mae >= 0
    assert row.arima_beats_naive_mae == (row.arima_mae < row.naive_mae)
    assert [tuple(r) for r in short_series(df, 8).collect()] == [("short", 13)]
    report = research.research_report(forecast_eval(df, predictions, 8), "forecast")
    assert report.select("evidence.naive_mae").count() == 2


def moving(phi, theta, n, seed):
    rng = np.random.default_rng(seed)
    noise, series = rng.normal(size=n + 100), np.zeros(n + 100)
    for t in range(1, n + 100):
        series[t] = phi * series[t - 1] + noise[t] + theta * noise[t - 1]
    return series[100:]


def plain_errors(w, phi, theta):
    """Conditional errors as defined, with zeros before the first value."""
    out = []
    for t, value in enumerate(w):
        out.append(
            value
            - sum(f * w[t - 1 - i] for i, f in enumerate(phi) if t - 1 - i >= 0)
            - sum(f * out[t - 1 - j] for j, f in enumerate(theta) if t - 1 - j >= 0)
        )
    return np.array(out)


def plain_forecast(closes, holdout, order):
    """Every candidate over every whole prefix; all steps offer their neighbours to each other."""
    p, d, q = order
    points = arma.first_points(p + q)
    for spacing in (*arma.SPACINGS[1:], 0):
        chosen, preds = [], []
        for k in range(holdout):
            known = closes[: len(closes) - holdout + k]
            w = np.diff(known, n=d)
            centre = w.mean() if d == 0 else 0.0
            fits = []
            for point in points:
                phi, theta = (x[0] for x in arma.split(point[None], p))
                errors = plain_errors(w - centre, phi, theta)
                rank = round(np.log((errors**2).sum()), 9)
                fits.append(((rank, np.abs(point).sum(), *point.tolist()), phi, theta, errors, point))
            _, phi, theta, errors, point = min(fits, key=lambda fit: fit[0])
            ahead = centre + sum(f * (w[-1 - i] - centre) for i, f in enumerate(phi))
            ahead += sum(f * errors[-1 - j] for j, f in enumerate(theta))
            preds.append(ahead + arma.carried(known, np.array([len(known)]), d)[0])
            chosen.append(point)
        points = arma.neighbours(np.array(chosen).reshape(holdout, p + q), spacing)
    return np.array(preds)


def series_frame(symbol, closes):
    times = np.arange(len(closes)) * 1000
    return pd.DataFrame({"symbol": symbol, "open_time_ms": times, "close": closes})


@pytest.mark.parametrize("block_rows", [11, 40, 8192])
@pytest.mark.parametrize("order", [(1, 1, 1), (0, 1, 0), (1, 0, 0), (0, 2, 1), (1, 0, 1)])
def test_forecasts_equal_the_definition_for_any_block(spark, order, block_rows):
    shapes = [("A", 0.6, 0.3, 90), ("B", -0.3, -0.4, 33), ("C", 0.2, 0.5, 16), ("D", 0.0, 0.0, 9)]
    frames = {s: 100 + np.cumsum(moving(phi, theta, n, n)) for s, phi, theta, n in shapes}
    df = spark.createDataFrame(pd.concat([series_frame(s, c) for s, c in frames.items()]))
    got = arima_forecast(df, 4, order, block_rows=block_rows).toPandas()
    assert set(got.symbol) == {"A", "B", "C"}
    for symbol, rows in got.groupby("symbol"):
        rows = rows.sort_values("step")
        np.testing.assert_allclose(rows.actual, frames[symbol][-4:])
        np.testing.assert_allclose(rows.pred, plain_forecast(frames[symbol], 4, order), atol=1e-6)
        assert not rows.fit_failed.any()


def test_blocks_change_nothing(spark):
    closes = 100 + np.cumsum(moving(0.5, -0.3, 700, 9))
    df = spark.createDataFrame(series_frame("A", closes))
    whole, cut = (
        arima_forecast(df, 10, block_rows=n).toPandas().sort_values("step") for n in (8192, 37)
    )
    np.testing.assert_allclose(whole.pred, cut.pred, atol=1e-8)
    assert whole.converged.all() and cut.converged.all()


@pytest.mark.parametrize("order", [(1, 1, 1), (2, 0, 1), (1, 0, 0), (0, 1, 2)])
def test_folded_blocks_forecast_alike(spark, monkeypatch, order):
    """Many rounds of folding, with groups that begin and end within a series."""
    closes = 100 + np.cumsum(np.random.default_rng(8).normal(size=400))
    df = spark.createDataFrame(series_frame("A", closes).iloc[:150]).unionByName(
        spark.createDataFrame(series_frame("B", closes))
    )
    whole = arima_forecast(df, 6, order).toPandas().sort_values(["symbol", "step"])
    monkeypatch.setattr(arima, "FOLD", 3)
    pieces = arima_forecast(df, 6, order, block_rows=11).toPandas().sort_values(["symbol", "step"])
    np.testing.assert_allclose(pieces.pred, whole.pred, rtol=1e-7)
    assert pieces.converged.tolist() == whole.converged.tolist()


def test_arima_hands_python_groups_of_bounded_size(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(
        pd.concat([series_frame(f"s{i:03}", 100 + rng.normal(size=20).cumsum()) for i in range(400)])
    )
    sizes, plans, spread, stored = [], [], arima.spread, arima.stored

    def seen_spread(given, *key):
        sizes.append(given.groupBy(*key).count().agg({"count": "max"}).first()[0])
        return spread(given, *key)

    def seen_stored(df, label):
        if label == "search":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(arima, "spread", seen_spread)
    monkeypatch.setattr(arima, "stored", seen_stored)
    got = arima_forecast(df, 10)
    assert got.count() == 4000
    # What MapInPandas gets at once follows the number of series in a partition.
    assert all(" MapInPandas" not in plan for plan in plans)
    assert sum("FlatMapGroupsInPandas" in plan for plan in plans) == 4
    assert max(sizes) <= 1024 // 20 + 1


def test_arima_predicts_better_than_naive_where_moves_persist(spark):
    closes = 100 + np.cumsum(moving(0.7, 0.2, 600, 3))
    rows = arima_forecast(spark.createDataFrame(series_frame("A", closes)), 60).toPandas()
    assert not rows.fit_failed.any()
    error = np.abs(rows.pred - rows.actual).mean()
    assert error < 0.85 * np.abs(np.diff(closes[-61:])).mean()


def test_failed_fits_fall_back_to_the_last_close(spark):
    rows = arima_forecast(spark.createDataFrame(series_frame("A", np.full(40, 5.0)))).toPandas()
    assert rows.fit_failed.all() and not rows.converged.any() and (rows.pred == 5.0).all()


# --- event studies


def shocked(spark, frame, at, factor=1.15):
    df = bars(spark, frame)
    event = df.filter(F.col("open_time_ms") == at * DAY).select("symbol", "open_time_ms")
    return inject_shock(df, event, factor, daily=True), event


def test_shock_changes_one_bar(spark):
    frame = walk(30, 3)
    df, _ = shocked(spark, frame, 12)
    got = df.toPandas().sort_values("open_time_ms", ignore_index=True)
    assert got.close[12] == pytest.approx(frame.close[11] * 1.15)
    assert got.high[12] == pytest.approx(max(frame.high[12], frame.close[11] * 1.15))
    others = got.index != 12
    np.testing.assert_array_equal(got.close[others], frame.close[others])
    first, _ = shocked(spark, frame, 0)
    assert first.filter("open_time_ms = 0").first().close == pytest.approx(frame.close[0])


@pytest.mark.parametrize("null", ["exact", "bootstrap"])
@pytest.mark.parametrize("daily", [True, False])
def test_event_study_sees_an_injected_jump(spark, null, daily):
    df, event = shocked(spark, walk(83, 3), 43)
    row = event_study(df, event, null=null, seed=3, daily=daily).first()
    assert row.abs_price_jump_pct == pytest.approx(15.0)
    assert row.diff_event_minus_pre > 0.05
    assert row.p_event_vs_pre < 0.05
    assert row.null_p2_5 <= 0 <= row.null_p97_5


def test_exact_null_equals_numpy(spark):
    frame = walk(60, 5)
    df = bars(spark, frame)
    rows = event_study(df, pre=12, post=7, daily=True).toPandas().set_index("open_time_ms")
    returns = np.diff(np.log(frame.close))
    assert sorted(rows.index) == [i * DAY for i in range(13, 53)]
    for event in (13, 30, 52):
        pre, move = returns[event - 13 : event - 1], returns[event - 1]
        row = rows.loc[event * DAY]
        null = pre - pre.mean()
        assert row.diff_event_minus_pre == pytest.approx(move - pre.mean())
        assert row.post_mean_log_return == pytest.approx(returns[event : event + 7].mean())
        assert row.null_p2_5 == pytest.approx(np.percentile(null, 2.5))
        assert row.null_p97_5 == pytest.approx(np.percentile(null, 97.5))
        assert row.p_event_vs_pre == pytest.approx(
            (np.abs(null) >= abs(move - pre.mean())).mean()
        )


def test_bootstrap_is_seeded_and_approaches_the_exact_null(spark):
    df = bars(spark, walk(60, 5))
    exact = event_study(df, daily=True).toPandas().set_index("open_time_ms")
    options = {"null": "bootstrap", "n_boot": 4000, "daily": True}
    one = event_study(df, **options).toPandas().set_index("open_time_ms")
    two = event_study(df.repartition(3), **options).toPandas().set_index("open_time_ms")
    other = event_study(df, seed=1, **options).toPandas().set_index("open_time_ms")
    pd.testing.assert_frame_equal(one.sort_index(), two.sort_index())
    assert (one.p_event_vs_pre - other.p_event_vs_pre.reindex(one.index)).abs().max() > 0
    assert (one.p_event_vs_pre - exact.p_event_vs_pre.reindex(one.index)).abs().max() < 0.05


def test_events_near_the_edges_are_rejected(spark):
    df = bars(spark, walk(30, 5))
    windows = event_windows(df, pre=10, post=10, daily=True)
    assert windows.filter("complete").count() == 30 - 11 - 10
    rejected = {row.open_time_ms // DAY for row in rejected_events(df, daily=True).collect()}
    assert rejected == {*range(11), *range(20, 30)}
    with pytest.raises(ValueError):
        event_study(df, null="guess")
