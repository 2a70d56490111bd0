"""The Markdown bias report, rendered from already aggregated results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row

from revaudit.operators.bias import ADVICE, LENGTH_BINS, bias_summary, monthly_trend
from revaudit.schema import CATEGORY_COLUMNS
from revaudit.settings import Settings


def _number(value: float | None) -> str:
    return "N/A" if value is None else f"{value:.2f}"


def _percent(ratio: float | None) -> str:
    return "N/A" if ratio is None else f"{ratio:.1%}"


def _mean_over(mean: float | None, count: int) -> str:
    return f"{_number(mean)} over {count} reviews"


def _rating_section(rating: Row) -> list[str]:
    return [
        "## Rating Distribution Analysis",
        "",
        f"- Mean Rating: {_number(rating['mean_rating'])}",
        f"- Positive Review Ratio: {_percent(rating['positive_ratio'])}",
        f"- Negative Review Ratio: {_percent(rating['negative_ratio'])}",
        f"- **Bias Status**: {rating['bias_detected']}",
        "",
    ]


def _length_section(analysis: Row) -> list[str]:
    bins = analysis["length_categories"]
    return [
        "### text_length_bias",
        *[f"- {name}: {_mean_over(*bins[name])}" for name, *_ in LENGTH_BINS],
        f"- Correlation with rating: {_number(analysis['correlation'])}",
        "",
    ]


def _category_section(title: str, imbalance: Row) -> list[str]:
    return [
        f"### {title}",
        f"- Imbalance Ratio: {_number(imbalance['imbalance_ratio'])}",
        f"- Most Common: {imbalance['most_common'] or 'N/A'}",
        f"- Least Common: {imbalance['least_common'] or 'N/A'}",
        "",
    ]


def _trend_section(months: Iterable[Row]) -> list[str]:
    lines = [f"- {m['month']}: {_mean_over(m['avg_rating'], m['count'])}" for m in months]
    return ["### temporal_bias", *lines, ""]


def render(
    summary: Mapping[str, Row], months: Iterable[Row] | None, generated_on: str | None = None
) -> list[str]:
    lines = ["# Bias Detection Report", ""]
    if generated_on:
        lines += [f"Generated on: {generated_on}", ""]
    rating = summary["rating_distribution"]
    lines += _rating_section(rating)
    lines += ["## Categorical Bias Analysis", ""]
    if "text_length_bias" in summary:
        lines += _length_section(summary["text_length_bias"])
    for category in CATEGORY_COLUMNS:
        title = f"{category}_bias"
        if title in summary:
            lines += _category_section(title, summary[title])
    if months is not None:
        lines += _trend_section(months)
    return [*lines, "## Mitigation Recommendations", "", *ADVICE[rating["bias_detected"]]]


def bias_report(
    df: DataFrame, settings: Settings = Settings(), generated_on: str | None = None
) -> list[str]:
    """The report's lines. Only one summary row and the calendar months are fetched."""
    summary = bias_summary(df, settings).first().asDict()
    months = monthly_trend(df).orderBy("month").collect() if "date" in df.columns else None
    return render(summary, months, generated_on)
