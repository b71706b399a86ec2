"""Anomaly, event-study and forecast reports: evidence rows with their reading notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.features import FEATURE_COLUMNS
from candlewick.operators.iforest import fit_iforest, score_iforest
from candlewick.sources.storage import stored

# Absolute daily return that counts as a spike by itself (fixed value).
SPIKE_RETURN = 0.1

NOTES = {
    "event_study": {
        "hypothesis": "event_log_return lies outside the pre_window returns of its own symbol.",
        "method": "p_event_vs_pre is the share of null values at least as far from zero as "
        "diff_event_minus_pre. The null holds each pre_window return less pre_mean_log_return: once "
        "each if exact, or seeded draws of them.",
        "limitations": [
            "Windows count rows, so missing days make them longer.",
            "An exact p-value is a multiple of 1 / n_pre; draws repeat the same n_pre values.",
            "null_p2_5 and null_p97_5 say where redrawn differences lie, not where the event's may.",
        ],
        "implications": [
            "Rows with too few returns on a side are found by rejected_events and are not in here.",
        ],
    },
    "forecast": {
        "hypothesis": "The arima row of a symbol has a smaller mae than its naive row.",
        "method": "Step k sees the rows before it and nothing else. Its coefficients are the best of "
        "a lattice that is narrowed around the best point, anew for every step.",
        "limitations": [
            "Coefficients are known to the finest spacing of the lattice only.",
            "A step whose fit is not usable repeats the last close and has fit_failed set.",
        ],
        "implications": [
            "Symbols with no more rows than the holdout and five have no rows in here.",
        ],
    },
}
ANOMALY_CAVEATS = [
    "Features are taken per symbol, but one forest scores the rows of all symbols.",
    "The share of flagged rows is the chosen contamination, whatever the data hold.",
]


def detect_anomalies(
    features: DataFrame,
    key: Sequence[str] = ("symbol", "open_time_ms"),
    trees: int = 100,
    contamination: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """Fit an isolation forest on the features and score the same rows.

    The features are counted, sampled and scored, so they are written once.
    """
    features = stored(features, "features")
    forest = fit_iforest(features, FEATURE_COLUMNS, key, trees=trees, seed=seed)
    return score_iforest(features, forest, contamination)


def top_anomalies(scored: DataFrame, top_k: int = 5) -> DataFrame:
    """The `top_k` lowest scores."""
    flagged = scored.orderBy("anomaly_score", "symbol", "open_time_ms").limit(top_k)
    return flagged.select(
        "open_time_ms", "symbol", "close", "return_1d", "volume", "anomaly_score", "is_anomaly"
    )


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Rows, flagged rows and their share (0 without rows)."""
    rows, flagged = F.count("*"), F.count_if("is_anomaly")
    rate = F.round(F.try_divide(flagged, rows), 4)
    return scored.agg(
        rows.alias("n_rows"),
        flagged.alias("n_anomalies"),
        F.coalesce(rate, F.lit(0.0)).alias("anomaly_rate"),
    )


def spike_flagged(scored: DataFrame) -> DataFrame:
    """Whether the oddest row is flagged or moved by more than SPIKE_RETURN."""
    spike = F.col("is_anomaly") | (F.abs("return_1d") > SPIKE_RETURN)
    return top_anomalies(scored, 1).agg(
        F.coalesce(F.max(spike), F.lit(False)).alias("spike_flagged")
    )


def anomaly_report(
    scored: DataFrame, seed: int = 42, top_k: int = 5, source: str = "", generated_at: str = ""
) -> DataFrame:
    """One row: summary, the top flags in score order, caveats."""
    top = top_anomalies(scored, top_k)
    # Exactly top_k rows reach this collect_list.
    ordered = F.sort_array(
        F.collect_list(
            F.struct(
                "anomaly_score",
                *[name for name in top.columns if name != "anomaly_score"],
            )
        )
    )
    flags = top.agg(ordered.alias("top_flags")).withColumn("_one", F.lit(1))
    summary = anomaly_summary(scored).withColumn("_one", F.lit(1))
    return summary.join(flags, "_one").select(
        F.lit(generated_at).alias("generated_at"),
        F.lit(source).alias("source"),
        F.struct(
            "n_rows",
            "n_anomalies",
            "anomaly_rate",
            F.lit(seed).alias("seed"),
            F.array(*map(F.lit, FEATURE_COLUMNS)).alias("feature_columns"),
        ).alias("summary"),
        "top_flags",
        F.array(*map(F.lit, ANOMALY_CAVEATS)).alias("caveats"),
    )


def research_report(
    evidence: DataFrame,
    kind: str,
    key: Sequence[str] = ("symbol",),
    source: str = "",
    generated_at: str = "",
) -> DataFrame:
    """One row per evidence row: its key, the reading notes and the evidence as a struct."""
    notes = NOTES[kind]
    texts = [
        (
            F.array(*map(F.lit, text)) if isinstance(text, list) else F.lit(text)
        ).alias(name)
        for name, text in notes.items()
    ]
    measured = [name for name in evidence.columns if name not in key]
    return evidence.select(
        *key,
        F.lit(generated_at).alias("generated_at"),
        F.lit(source).alias("source"),
        *texts,
        F.struct(*measured).alias("evidence"),
    )
