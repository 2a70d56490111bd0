"""Thresholds of the cleaning and audit operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # The published defaults of each check.
    min_text_length: int = 10
    max_text_length: int = 5000
    rating_low: float = 1
    rating_high: float = 5
    positive_from: float = 4
    negative_to: float = 2
    neutral_at: float = 3
    positive_share_limit: float = 0.7
    negative_share_limit: float = 0.5
    iqr_multiplier: float = 1.5
    z_limit: float = 3.0
    short_text_below: int = 10
    vote_quantile: float = 0.95
    sample_rows: int = 10

    # Optional cleaning steps, off unless asked for.
    strip_tags: bool = False
    rich_columns: bool = False
    filter_length: bool = False
    drop_duplicate_ids: bool = False
