"""Review schemas, one per layer, and the column groups the operators share."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


VOTE_COLUMNS = ("useful_votes", "funny_votes", "cool_votes")
NUMERIC_COLUMNS = (*VOTE_COLUMNS, "text_length")
CRITICAL_COLUMNS = ("review_id", "rating", "text")
CATEGORY_COLUMNS = ("business_category", "platform")
LONG_TEXT_COLUMNS = ("text", "cleaned_text")

# The column types the type check expects, as pandas names.
EXPECTED_TYPES = {
    "review_id": "object",
    "rating": "int64",
    "text": "object",
    "useful_votes": "int64",
}

RAW_REVIEW = _struct(
    review_id=T.StringType(),
    business_id=T.StringType(),
    user_id=T.StringType(),
    text=T.StringType(),
    rating=T.LongType(),
    date=T.StringType(),
    useful_votes=T.LongType(),
    funny_votes=T.LongType(),
    cool_votes=T.LongType(),
    text_length=T.LongType(),
    business_category=T.StringType(),
    has_owner_response=T.BooleanType(),
    platform=T.StringType(),
    sentiment_label=T.StringType(),
)

RAW_REVIEW_EXTENDED = _struct(
    review_id=T.StringType(),
    business_id=T.StringType(),
    user_id=T.StringType(),
    text=T.StringType(),
    rating=T.LongType(),
    date=T.StringType(),
    time=T.StringType(),
    useful_votes=T.LongType(),
    funny_votes=T.LongType(),
    cool_votes=T.LongType(),
    text_length=T.LongType(),
    business_category=T.StringType(),
    response_time_hours=T.DoubleType(),
    has_owner_response=T.BooleanType(),
    verified_purchase=T.BooleanType(),
    platform=T.StringType(),
    language=T.StringType(),
    sentiment_label=T.StringType(),
)

# Types of every column a cleaned review may carry; used when reading untyped files.
CLEAN_TYPES = {
    **{field.name: field.dataType for field in RAW_REVIEW_EXTENDED},
    "rating": T.DoubleType(),
    "cleaned_text": T.StringType(),
    "word_count": T.LongType(),
    "avg_word_length": T.DoubleType(),
    "useful_votes_normalized": T.DoubleType(),
}
