"""Data-quality report over the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rule, severity, in report order.
RULES = [
    ("no_null_close", "CRITICAL"),
    ("no_null_ticker", "CRITICAL"),
    ("close_positive", "CRITICAL"),
    ("high_gte_low", "WARNING"),
    ("volume_non_negative", "WARNING"),
    ("sma_7_not_null_after_day_7", "INFO"),
    ("rsi_in_range", "WARNING"),
    ("outlier_pct_below_5", "WARNING"),
]
MAX_OUTLIER_PCT = 5.0


class CriticalQualityError(RuntimeError):
    """A critical rule failed and the job was told to stop on that."""


def quality_report(silver: DataFrame) -> DataFrame:
    """One row per rule, from one pass: counts per series first (map-side), then their sums."""
    present = set(silver.columns)
    rsi, close = F.col("rsi_14"), F.col("close")
    violations = {
        "no_null_close": F.count_if(close.isNull()),
        "no_null_ticker": F.count_if(F.col("ticker").isNull()),
        "close_positive": F.count_if(close <= 0),
        "high_gte_low": F.count_if(F.col("high") < F.col("low")),
        "volume_non_negative": F.count_if(F.col("volume") < 0),
    }
    if "sma_7" in present:
        # the first six rows of a series have no average; any further null is a violation
        missing = F.count_if(F.col("sma_7").isNull())
        violations["sma_7_not_null_after_day_7"] = F.greatest(
            missing - F.least(F.lit(6), F.count(F.lit(1))), F.lit(0))
    if "rsi_14" in present:
        violations["rsi_in_range"] = F.count_if((rsi < 0) | (rsi > 100))
    if "is_outlier" in present:
        violations["outlier_pct_below_5"] = F.count_if(F.col("is_outlier"))

    series = [c for c in ("ticker", "bar_interval") if c in present]
    per_series = silver.groupBy(*series).agg(
        F.count(F.lit(1)).alias("total_rows"), *[v.alias(k) for k, v in violations.items()]
    )
    totals = per_series.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                              for c in ("total_rows", *violations)])

    rows = []
    for rule, severity in RULES:
        if rule not in violations:
            continue
        found, total = F.col(rule), F.col("total_rows")
        passed = found == 0
        if rule == "outlier_pct_below_5":
            passed = F.coalesce(F.try_divide(100 * found, total) < MAX_OUTLIER_PCT, F.lit(True))
        rows.append(F.struct(
            F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), passed.alias("pass"),
            found.alias("violations"), total.alias("total_rows"),
        ))
    return totals.select(F.inline(F.array(*rows)))


def verdict(report: DataFrame) -> DataFrame:
    """Overall result: all passed, warnings only, or a critical rule failed."""
    failed = ~F.col("pass")
    critical = F.coalesce(F.bool_or(failed & (F.col("severity") == "CRITICAL")), F.lit(False))
    return report.agg(
        F.when(critical, "critical_failed")
        .when(F.coalesce(F.bool_or(failed), F.lit(False)), "warnings")
        .otherwise("all_passed").alias("verdict"),
        F.count_if(failed).alias("failed_rules"),
        F.count(F.lit(1)).alias("rules"),
    )


def stop_on_critical(report: DataFrame) -> None:
    failed = [r["rule"] for r in report.filter("not pass and severity = 'CRITICAL'").collect()]
    if failed:  # at most one row per rule reaches the driver
        raise CriticalQualityError(f"critical rules failed: {failed}")
