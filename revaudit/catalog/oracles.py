"""The same queries in DuckDB SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from revaudit.catalog.tables import ORDER_REVIEWS, REPEATED_USER, REVIEWS
from revaudit.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from revaudit.operators import generate as gen
from revaudit.operators.bias import ADVICE, LENGTH_BINS, NEGATIVE_BIAS, NO_BIAS, POSITIVE_BIAS
from revaudit.sources.readers import NA_TOKENS

# The code points Python counts as whitespace, as an RE2 class.
_WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

_REVIEW_COLUMNS = (
    "review_id", "business_id", "user_id", "text", "rating", "date", "useful_votes",
    "funny_votes", "cool_votes", "text_length", "business_category", "has_owner_response",
    "platform",
)


def _clean(text: str, strip_tags: bool = False) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), 'http[^{_WS}]+|www[^\\n][^{_WS}]+', '', 'g')"
    if strip_tags:
        out = f"regexp_replace({out}, '<[^\\n]*?>', '', 'g')"
    out = f"regexp_replace({out}, '[^a-zA-Z0-9{_WS}.,!?]', '', 'g')"
    return f"trim(regexp_replace({out}, '[{_WS}]+', ' ', 'g'))"


def _words(text: str) -> str:
    return (
        f"CASE WHEN {text} = '' THEN CAST(0 AS BIGINT)"
        f" ELSE CAST(len(string_split({text}, ' ')) AS BIGINT) END"
    )


def _filled(source: str) -> str:
    return f"""
SELECT * REPLACE (coalesce(text, '') AS text,
  coalesce(CAST(rating AS DOUBLE), (SELECT median(rating) FROM {source})) AS rating,
  coalesce(useful_votes, 0) AS useful_votes, coalesce(funny_votes, 0) AS funny_votes,
  coalesce(cool_votes, 0) AS cool_votes)
FROM {source} WHERE review_id IS NOT NULL"""


def _cleaned(source: str, strip_tags: bool = False) -> str:
    return f"""
SELECT * REPLACE (CAST(length(cleaned_text) AS BIGINT) AS text_length),
  {_words('cleaned_text')} AS word_count
FROM (SELECT *, {_clean('text', strip_tags)} AS cleaned_text FROM ({_filled(source)}))
WHERE cleaned_text <> ''"""


_VIEWS = {
    "reviews": REVIEWS.format(documents="documents"),
    "reviews_dup": f"SELECT * FROM reviews UNION ALL SELECT * FROM reviews WHERE {REPEATED_USER}",
    "order_reviews": ORDER_REVIEWS.format(orders="orders"),
    "clean": _cleaned("reviews"),
    "clean_dup": _cleaned("reviews_dup"),
    "worded": f"SELECT *, {_clean('text')} AS cleaned_text FROM reviews",
}
_NEEDS = {
    "reviews": ("reviews",),
    "reviews_dup": ("reviews", "reviews_dup"),
    "order_reviews": ("order_reviews",),
    "clean": ("reviews", "clean"),
    "clean_dup": ("reviews", "reviews_dup", "clean_dup"),
    "worded": ("reviews", "worded"),
}


def _with(view: str, sql: str) -> str:
    parts = [f"{name} AS ({_VIEWS[name]})" for name in _NEEDS[view]]
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()


def _r(number: str) -> str:
    return f"round(CAST({number} AS DOUBLE), 6)"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _share(condition: str) -> str:
    return f"avg(CAST({_flag(condition)} AS DOUBLE))"


def _hits(text: str, words: tuple[str, ...]) -> str:
    return " + ".join(f"CASE WHEN {text} LIKE '%{word}%' THEN 1 ELSE 0 END" for word in words)


_TEMPORAL = (
    "CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,"
    " CAST(quarter(date) AS INTEGER) AS quarter,"
    f" {_flag('isodow(date) >= 6')} AS is_weekend"
)
_FLAGS = (
    f"{_flag('rating >= 4')} AS is_positive, {_flag('rating <= 2')} AS is_negative,"
    f" {_flag('rating = 3')} AS is_neutral"
)
_LEXICON = (
    f"{_hits('cleaned_text', POSITIVE_WORDS)} AS positive_word_count,"
    f" {_hits('cleaned_text', NEGATIVE_WORDS)} AS negative_word_count"
)
_INTERACTION = (
    f"{_r('rating * text_length')} AS rating_length_interaction,"
    f" {_r('CAST(useful_votes AS DOUBLE) / (text_length + 1)')} AS votes_to_length_ratio"
)


def _business_stats(source: str) -> str:
    return f"""
SELECT business_id, {_r('avg(rating)')} AS business_avg_rating,
  {_r('stddev_samp(rating)')} AS business_rating_std,
  count(rating) AS business_review_count,
  CAST(coalesce(sum(useful_votes), 0) AS BIGINT) AS business_total_useful_votes
FROM {source} WHERE business_id IS NOT NULL GROUP BY business_id"""


def _business_features(source: str, columns: str) -> str:
    return f"""
SELECT {columns}, business_avg_rating, business_rating_std, business_review_count,
  business_total_useful_votes
FROM {source} LEFT JOIN ({_business_stats(source)}) AS stats USING (business_id)"""


def _skewness(value: str) -> str:
    return (
        f"CASE WHEN count({value}) < 3 THEN NULL WHEN stddev_pop({value}) = 0 THEN 0"
        f" ELSE skewness({value}) END"
    )


_RATIOS = (
    f"{_share('rating >= 4')} AS positive_ratio, {_share('rating <= 2')} AS negative_ratio,"
    f" {_share('rating = 3')} AS neutral_ratio"
)
_VERDICT = (
    f"CASE WHEN positive_ratio > 0.7 THEN '{POSITIVE_BIAS}'"
    f" WHEN negative_ratio > 0.5 THEN '{NEGATIVE_BIAS}' ELSE '{NO_BIAS}' END"
)


def _rating_summary(source: str) -> str:
    return f"""
SELECT {_r('avg(rating)')} AS mean_rating, {_r('median(rating)')} AS median_rating,
  {_r('stddev_samp(rating)')} AS std_rating, {_r(_skewness('rating'))} AS skewness,
  {_r(_share('rating >= 4'))} AS positive_ratio, {_r(_share('rating <= 2'))} AS negative_ratio,
  {_r(_share('rating = 3'))} AS neutral_ratio
FROM {source}"""


def _rating_distribution(source: str) -> str:
    return f"""
SELECT rating, {_r(f'count(*) / (SELECT count(rating) FROM {source})')} AS share
FROM {source} WHERE rating IS NOT NULL GROUP BY rating"""


def _category_bias(source: str, category: str, rating: str = "rating") -> str:
    known = f"{category} IS NOT NULL"
    return f"""
SELECT CAST({category} AS VARCHAR) AS category, count({category}) AS count,
  {_r(f'count({category}) * 100.0 / (SELECT count(*) FROM {source})')} AS percentage,
  {_r(f'avg({rating}) FILTER ({known})')} AS avg_rating,
  {_r(f'stddev_samp({rating}) FILTER ({known})')} AS rating_std
FROM {source} GROUP BY {category}"""


def _imbalance(source: str, category: str) -> str:
    counts = (
        f"(SELECT coalesce({category}, 'nan') AS category, count({category}) AS n"
        f" FROM {source} GROUP BY {category})"
    )
    return f"""
SELECT {_r("CASE WHEN min(n) = 0 THEN CAST('inf' AS DOUBLE) ELSE max(n) / min(n) END")}
    AS imbalance_ratio,
  (SELECT category FROM {counts} ORDER BY n DESC, category LIMIT 1) AS most_common,
  (SELECT category FROM {counts} ORDER BY n, category LIMIT 1) AS least_common
FROM {counts}"""


def _monthly(source: str) -> str:
    return f"""
SELECT strftime(date, '%Y-%m') AS month, {_r('avg(rating)')} AS avg_rating,
  {_r('stddev_samp(rating)')} AS rating_std, count(rating) AS count
FROM {source} WHERE date IS NOT NULL GROUP BY 1"""


def _bin_condition(above: int, upto: int | None) -> str:
    return f"text_length > {above}" + ("" if upto is None else f" AND text_length <= {upto}")


def _length_bias(source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{label}' AS length_category,"
        f" {_r('avg(rating)')} AS mean, count(rating) AS count"
        f" FROM {source} WHERE {_bin_condition(above, upto)}"
        for label, above, upto in LENGTH_BINS
    )


def _correlation(source: str) -> str:
    return f"""
SELECT {_r('covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0)')} AS correlation
FROM (SELECT CAST(text_length AS DOUBLE) AS x, CAST(rating AS DOUBLE) AS y FROM {source}
      WHERE text_length IS NOT NULL AND rating IS NOT NULL)"""


def _iqr(source: str, column: str, shown: str = "*", reach: float = 1.5) -> str:
    return f"""
SELECT {shown} FROM {source},
  (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
          quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source}) AS cuts
WHERE {column} < q1 - {reach} * (q3 - q1) OR {column} > q3 + {reach} * (q3 - q1)"""


def _z(source: str, column: str, shown: str = "*") -> str:
    return f"""
SELECT {shown} FROM {source},
  (SELECT avg({column}) AS mean, stddev_pop({column}) AS deviation FROM {source}) AS moments
WHERE abs({column} - mean) / nullif(deviation, 0) > 3"""


_MEASURED = ("useful_votes", "funny_votes", "cool_votes", "text_length")


def _outlier_counts(source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{column}' AS \"column\", '{method}' AS method, count(*) AS outliers"
        f" FROM ({find(source, column, column)})"
        for column in _MEASURED
        for method, find in (("iqr", _iqr), ("zscore", _z))
    )


def _types(source: str) -> dict[str, str]:
    whole = (
        "SELECT CASE WHEN count({c}) = count(*) THEN 'int64' ELSE 'float64' END FROM " + source
    )
    return {
        "review_id": "'object'",
        "rating": f"({whole.format(c='rating')})",
        "text": "'object'",
        "useful_votes": f"({whole.format(c='useful_votes')})",
    }


_EXPECTED = {
    "review_id": "object", "rating": "int64", "text": "object", "useful_votes": "int64",
}
_CRITICAL = ("review_id", "rating", "text")


def _check_types(source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{column}' AS \"column\", '{_EXPECTED[column]}' AS expected,"
        f" {actual} AS actual, contains({actual}, '{_EXPECTED[column]}') AS valid"
        for column, actual in _types(source).items()
    )


def _range_rating(source: str) -> str:
    return f"""
SELECT min(rating) AS min, max(rating) AS max,
  coalesce(min(rating) >= 1 AND max(rating) <= 5, false) AS valid,
  count(*) FILTER (rating < 1 OR rating > 5) AS out_of_range_count
FROM {source}"""


def _range_lengths(source: str) -> str:
    return f"""
SELECT min(text_length) AS min, max(text_length) AS max, {_r('avg(text_length)')} AS mean,
  count(*) FILTER (text_length = 0) AS empty_count
FROM {source}"""


def _range_votes(source: str) -> str:
    return f"""
SELECT count(*) FILTER (useful_votes < 0) AS negative_count,
  coalesce(bool_and(coalesce(useful_votes >= 0, false)), true) AS valid
FROM {source}"""


def _missing(source: str, columns: tuple[str, ...]) -> str:
    percentage = "round_even((count(*) - count({c})) / count(*) * 100, 2)"
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count,"
        f" {_r(percentage.format(c=c))} AS missing_percentage,"
        f" {str(c in _CRITICAL).lower()} AS is_critical FROM {source}"
        for c in columns
    )


def _column_checks(source: str) -> str:
    """Nulls of every column, and ranges of the numeric ones, column by column."""
    rules = {
        "rating": "rating < 1 OR rating > 5", "text_length": "text_length = 0",
        "useful_votes": "useful_votes < 0",
    }
    numbers = ("rating", *_MEASURED)
    none = "CAST(NULL AS DOUBLE)"
    lines = []
    for c in _REVIEW_COLUMNS:
        low, high, mean = (
            _r(f"{f}({c})") if c in numbers else none for f in ("min", "max", "avg")
        )
        broken = f"count(*) FILTER ({rules.get(c, 'false')})"
        lines.append(
            f"SELECT '{c}' AS \"column\", count(*) AS rows, {low} AS min, {high} AS max,"
            f" {mean} AS mean, {broken} AS broken_count, {broken} = 0 AS valid FROM {source}"
        )
    joined = "\nUNION ALL\n".join(lines)
    return f"""
SELECT * FROM ({joined}) JOIN ({_missing(source, _REVIEW_COLUMNS)}) USING ("column")"""


def _outlier_rows(source: str) -> str:
    """Rows outside the quartiles or far from the mean of any measured column, with the tests' names."""
    cuts = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1_{c},"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3_{c},"
        f" avg({c}) AS mean_{c}, stddev_pop({c}) AS deviation_{c}"
        for c in _MEASURED
    )
    tests = ", ".join(
        f"CASE WHEN {c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c})"
        f" THEN '{c}.iqr' END,"
        f" CASE WHEN abs({c} - mean_{c}) / nullif(deviation_{c}, 0) > 3 THEN '{c}.zscore' END"
        for c in _MEASURED
    )
    return f"""
SELECT * FROM (
  SELECT review_id, user_id, {', '.join(_MEASURED)}, concat_ws(', ', {tests}) AS found_by
  FROM {source}, (SELECT {cuts} FROM {source}))
WHERE found_by <> ''"""


def _members(source: str, keys: str) -> str:
    return (
        f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM"
        f" (SELECT count(*) AS n FROM {source} GROUP BY {keys}) WHERE n > 1)"
    )


def _duplicate_counts(source: str, columns: tuple[str, ...] = _REVIEW_COLUMNS) -> str:
    return f"""
SELECT {_members(source, 'review_id')} AS duplicate_review_ids,
  {_members(source, 'text')} AS duplicate_texts,
  {_members(source, ', '.join(columns))} AS exact_duplicates"""


def _issues(source: str, columns: tuple[str, ...]) -> str:
    found = [
        f"CASE WHEN {_members(source, 'review_id')} > 0 THEN 'Duplicate review IDs found' END"
    ]
    found += [
        f"CASE WHEN (SELECT count(*) - count({c}) FROM {source}) > 0"
        f" THEN 'Critical column ''{c}'' has missing values' END"
        for c in columns
        if c in _CRITICAL
    ]
    return f"concat_ws(', ', {', '.join(found)})"


def _verdict(source: str, columns: tuple[str, ...] = _REVIEW_COLUMNS) -> str:
    return f"""
SELECT issues = '' AS validation_passed, issues
FROM (SELECT {_issues(source, columns)} AS issues)"""


def _number(path: str, value: str) -> str:
    return f"SELECT '{path}' AS path, {_r(value)} AS number, CAST(NULL AS VARCHAR) AS label"


def _label(path: str, value: str) -> str:
    return f"SELECT '{path}' AS path, CAST(NULL AS DOUBLE) AS number, {value} AS label"


def _truth(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'true' ELSE 'false' END"


def _validation_report(source: str, columns: tuple[str, ...]) -> str:
    rows = [
        _label("file_path", "CAST(NULL AS VARCHAR)"),
        _number("total_records", f"(SELECT count(*) FROM {source})"),
        _number("total_columns", str(len(columns))),
        _label("column_names", "'" + ", ".join(columns) + "'"),
    ]
    for column, actual in _types(source).items():
        at = f"data_types.{column}"
        valid = _truth(f"contains({actual}, '{_EXPECTED[column]}')")
        rows += [
            _label(f"{at}.expected", f"'{_EXPECTED[column]}'"),
            _label(f"{at}.actual", actual),
            _label(f"{at}.valid", valid),
        ]
    for at, sql, numbers, truths in (
        ("rating", _range_rating(source), ("min", "max", "out_of_range_count"), ("valid",)),
        ("text_length", _range_lengths(source), ("min", "max", "mean", "empty_count"), ()),
        ("useful_votes", _range_votes(source), ("negative_count",), ("valid",)),
    ):
        rows += [
            _number(f"data_ranges.{at}.{name}", f'(SELECT "{name}" FROM ({sql}))')
            for name in numbers
        ]
        rows += [
            _label(f"data_ranges.{at}.{name}", _truth(f'(SELECT "{name}" FROM ({sql}))'))
            for name in truths
        ]
    rows += [
        f"""
SELECT concat('missing_values.', "column", '.', metric) AS path,
  CASE metric WHEN 'missing_count' THEN missing_count WHEN 'missing_percentage'
       THEN missing_percentage END AS number,
  CASE metric WHEN 'is_critical' THEN {_truth('is_critical')} END AS label
FROM ({_missing(source, columns)}),
  (VALUES ('missing_count'), ('missing_percentage'), ('is_critical')) AS metrics(metric)"""
    ]
    for name in ("duplicate_review_ids", "duplicate_texts", "exact_duplicates"):
        rows.append(
            _number(f"duplicates.{name}",
                    f"(SELECT {name} FROM ({_duplicate_counts(source, columns)}))")
        )
    issues = _issues(source, columns)
    rows += [_label("validation_passed", _truth(f"{issues} = ''")), _label("issues", issues)]
    return "\nUNION ALL\n".join(rows)


def _table_facts(section: str, key: str, values: tuple[str, ...], sql: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT concat('{section}.', coalesce(CAST(\"{key}\" AS VARCHAR), 'nan'), '.{value}')"
        f" AS path, {_r(value)} AS number, CAST(NULL AS VARCHAR) AS label FROM ({sql})"
        for value in values
    )


def _bias_analysis(source: str) -> str:
    rows = [
        _number(f"rating_distribution.{name}", f"(SELECT {name} FROM ({_rating_summary(source)}))")
        for name in (
            "mean_rating", "median_rating", "std_rating", "skewness", "positive_ratio",
            "negative_ratio", "neutral_ratio",
        )
    ]
    rows.append(
        _label(
            "rating_distribution.bias_detected",
            f"(SELECT {_VERDICT} FROM (SELECT {_RATIOS} FROM {source}))",
        )
    )
    rows.append(
        _table_facts(
            "text_length_bias.length_categories", "length_category", ("mean", "count"),
            _length_bias(source),
        )
    )
    rows.append(
        _number("text_length_bias.correlation", f"(SELECT correlation FROM ({_correlation(source)}))")
    )
    for category in ("business_category", "platform"):
        sql = _imbalance(source, category)
        rows += [
            _number(f"{category}_bias.imbalance_ratio", f"(SELECT imbalance_ratio FROM ({sql}))"),
            _label(f"{category}_bias.most_common", f"(SELECT most_common FROM ({sql}))"),
            _label(f"{category}_bias.least_common", f"(SELECT least_common FROM ({sql}))"),
            _table_facts(
                f"{category}_bias.categories", "category",
                ("count", "percentage", "avg_rating", "rating_std"),
                _category_bias(source, category),
            ),
        ]
    rows.append(
        _table_facts(
            "rating_distribution.distribution", "rating", ("share",), _rating_distribution(source)
        )
    )
    rows.append(
        _table_facts(
            "temporal_bias.monthly_trend", "month", ("avg_rating", "rating_std", "count"),
            _monthly(source),
        )
    )
    return "\nUNION ALL\n".join(rows)


def _recommendations(source: str) -> str:
    lines = []
    for case, advice in (
        ("positive_ratio > 0.7", ADVICE[POSITIVE_BIAS]),
        ("positive_ratio <= 0.7 AND negative_ratio > 0.5", ADVICE[NEGATIVE_BIAS]),
        ("positive_ratio <= 0.7 AND negative_ratio <= 0.5", ADVICE[NO_BIAS]),
    ):
        lines += [
            f"SELECT CAST({i} AS INTEGER) AS position, '{line}' AS line FROM ratios WHERE {case}"
            for i, line in enumerate(advice, 1)
        ]
    return f"SELECT * FROM (WITH ratios AS (SELECT {_RATIOS} FROM {source})\n" + (
        "\nUNION ALL\n".join(lines) + ")"
    )


def _shown(number: str) -> str:
    return f"CASE WHEN isinf({number}) THEN 'inf' ELSE coalesce(printf('%.2f', {number}), 'N/A') END"


def _bias_report(source: str) -> str:
    """The report as (line_number, line), put together from sections in order."""

    def fixed(text: str) -> str:
        return f"'{text}'"

    def mean_over(mean: str, count: str) -> str:
        return f"concat({_shown(mean)}, ' over ', {count}, ' reviews')"

    summary = (
        f"(SELECT avg(rating) AS mean_rating, {_RATIOS} FROM {source})"
    )
    singles = [
        fixed("# Bias Detection Report"), fixed(""),
        fixed("## Rating Distribution Analysis"), fixed(""),
        f"(SELECT concat('- Mean Rating: ', {_shown('mean_rating')}) FROM {summary})",
        f"(SELECT printf('- Positive Review Ratio: %.1f%%', positive_ratio * 100) FROM {summary})",
        f"(SELECT printf('- Negative Review Ratio: %.1f%%', negative_ratio * 100) FROM {summary})",
        f"(SELECT concat('- **Bias Status**: ', {_VERDICT}) FROM {summary})",
        fixed(""), fixed("## Categorical Bias Analysis"), fixed(""),
        fixed("### text_length_bias"),
    ]
    for label, above, upto in LENGTH_BINS:
        singles.append(
            f"(SELECT concat('- {label}: ', {mean_over('avg(rating)', 'count(rating)')})"
            f" FROM {source} WHERE {_bin_condition(above, upto)})"
        )
    singles += [
        f"(SELECT concat('- Correlation with rating: ', {_shown('correlation')})"
        f" FROM ({_correlation(source)}))",
        fixed(""),
    ]
    for category in ("business_category", "platform"):
        sql = _imbalance(source, category)
        singles += [
            fixed(f"### {category}_bias"),
            f"(SELECT concat('- Imbalance Ratio: ', {_shown('imbalance_ratio')}) FROM ({sql}))",
            f"(SELECT concat('- Most Common: ', most_common) FROM ({sql}))",
            f"(SELECT concat('- Least Common: ', least_common) FROM ({sql}))",
            fixed(""),
        ]
    singles.append(fixed("### temporal_bias"))
    rows = [
        f"SELECT 0 AS part, '' AS key, {i} AS place, {line} AS line"
        for i, line in enumerate(singles)
    ]
    rows.append(
        "SELECT 1, month, 0, concat('- ', month, ': ',"
        f" {mean_over('avg_rating', 'count')}) FROM ({_monthly(source)})"
    )
    rows += [
        f"SELECT 2, '', {i}, '{line}'"
        for i, line in enumerate(("", "## Mitigation Recommendations", ""))
    ]
    rows.append(f"SELECT 3, '', position, line FROM ({_recommendations(source)})")
    union = "\nUNION ALL\n".join(rows)
    return f"""
SELECT row_number() OVER (ORDER BY part, key, place) AS line_number, line FROM ({union})"""


def _first_ids(hits: str) -> str:
    return f"""
SELECT (SELECT count(*) FROM ({hits})) AS matches, review_id FROM ({hits})
ORDER BY review_id NULLS LAST LIMIT 10"""


_SHORT = "SELECT * FROM {source} WHERE text_length < 10"
_ODD_VOTES = (
    "SELECT * FROM {source} WHERE rating <= 2 AND useful_votes >"
    " (SELECT quantile_cont(CAST(useful_votes AS DOUBLE), 0.95) FROM {source})"
)


def _repeated(source: str) -> str:
    return (
        "(SELECT count(*) FROM (SELECT 1 FROM " + source + " WHERE business_id IS NOT NULL"
        " AND text IS NOT NULL GROUP BY business_id, text HAVING count(*) > 1))"
    )


def _pattern_counts(source: str) -> dict[str, str]:
    return {
        "short_reviews": f"(SELECT count(*) FROM ({_SHORT.format(source=source)}))",
        "odd_votes": f"(SELECT count(*) FROM ({_ODD_VOTES.format(source=source)}))",
        "repeated_groups": _repeated(source),
    }


def _suspicious(source: str) -> str:
    described = (
        ("very_short_reviews", "Reviews with less than 10 characters"),
        ("suspicious_vote_pattern", "Low ratings with unusually high useful votes"),
        ("repeated_reviews_per_business", "Identical reviews for the same business"),
    )
    rows = "\nUNION ALL\n".join(
        f"SELECT '{kind}' AS type, {count} AS count, '{text}' AS description"
        for (kind, text), count in zip(described, _pattern_counts(source).values())
    )
    return f"SELECT * FROM ({rows}) WHERE count > 0"


def _duplicate_rows(source: str, columns: tuple[str, ...] = _REVIEW_COLUMNS) -> str:
    keys = {"review_id": "review_id", "text": "text", "all_columns": ", ".join(columns)}
    return "\nUNION ALL\n".join(
        f"""
SELECT '{name}' AS duplicate_set, CAST(position AS INTEGER) AS position, review_id FROM (
  SELECT review_id, row_number() OVER (ORDER BY review_id NULLS LAST) AS position
  FROM (SELECT review_id, count(*) OVER (PARTITION BY {columns}) AS n FROM {source})
  WHERE n > 1) WHERE position <= 10"""
        for name, columns in keys.items()
    )


def _missing_patterns(source: str) -> str:
    return "\nUNION ALL\n".join(
        f"""
SELECT '{c}' AS "column", missing_count, {_r('missing_percentage')} AS missing_percentage,
  CAST(position AS INTEGER) AS position, review_id
FROM (SELECT review_id, row_number() OVER (ORDER BY review_id NULLS LAST) AS position
      FROM {source} WHERE {c} IS NULL),
  (SELECT count(*) - count({c}) AS missing_count,
          (count(*) - count({c})) / count(*) * 100 AS missing_percentage FROM {source})
WHERE position <= 10"""
        for c in _REVIEW_COLUMNS
    )


def _alert_row(source: str, columns: tuple[str, ...] = _REVIEW_COLUMNS) -> str:
    kinds = " + ".join(f"CAST({count} > 0 AS INTEGER)" for count in _pattern_counts(source).values())
    exact = _members(source, ", ".join(columns))
    return f"""
SELECT *, CASE WHEN total_outliers = 0 AND exact_duplicates = 0 AND pattern_types = 0
  THEN '✓ No critical anomalies detected'
  ELSE concat_ws(chr(10),
    CASE WHEN total_outliers > 0
         THEN concat('⚠️ ALERT: ', total_outliers, ' outliers detected') END,
    CASE WHEN exact_duplicates > 0
         THEN concat('⚠️ ALERT: ', exact_duplicates, ' duplicate records found') END,
    CASE WHEN pattern_types > 0
         THEN concat('⚠️ ALERT: ', pattern_types, ' suspicious patterns detected') END) END AS alert
FROM (SELECT (SELECT CAST(sum(outliers) AS BIGINT) FROM ({_outlier_counts(source)}))
               AS total_outliers,
             {exact} AS exact_duplicates, CAST({kinds} AS BIGINT) AS pattern_types)"""


def _anomaly_report(source: str) -> str:
    rows = [
        f"SELECT concat('outliers.', \"column\", '.', method) AS path,"
        f" CAST(outliers AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS label"
        f" FROM ({_outlier_counts(source)})"
    ]
    for name in ("duplicate_review_ids", "duplicate_texts", "exact_duplicates"):
        rows.append(
            _number(f"duplicates.{name}", f"(SELECT {name} FROM ({_duplicate_counts(source)}))")
        )
    sampled = {"review_id_sample": "review_id", "text_sample": "text", "exact_sample": "all_columns"}
    rows += [
        _label(f"duplicates.{name}", f"""coalesce((
SELECT string_agg(review_id, ', ' ORDER BY position) FROM ({_duplicate_rows(source)})
WHERE duplicate_set = '{chosen}'), '')""")
        for name, chosen in sampled.items()
    ]
    hits = {
        "very_short_reviews": _SHORT.format(source=source),
        "suspicious_vote_pattern": _ODD_VOTES.format(source=source),
        "repeated_reviews_per_business": f"SELECT * FROM {source} WHERE false",
    }
    for kind, found in hits.items():
        at, own = f"suspicious_patterns.{kind}", f"FROM ({_suspicious(source)}) WHERE type = '{kind}'"
        sample = f"(SELECT string_agg(review_id, ', ' ORDER BY review_id) FROM ({_first_ids(found)}))"
        rows += [
            f"SELECT '{at}.count', CAST(count AS DOUBLE), CAST(NULL AS VARCHAR) {own}",
            f"SELECT '{at}.description', CAST(NULL AS DOUBLE), description {own}",
            f"SELECT '{at}.sample', CAST(NULL AS DOUBLE), coalesce({sample}, '') {own}",
        ]
    listed = f"({_missing_patterns(source)})"
    rows += [
        f"""SELECT concat('missing_patterns.', "column", '.missing_count'),
CAST(any_value(missing_count) AS DOUBLE), CAST(NULL AS VARCHAR) FROM {listed} GROUP BY "column" """,
        f"""SELECT concat('missing_patterns.', "column", '.missing_percentage'),
any_value(missing_percentage), CAST(NULL AS VARCHAR) FROM {listed} GROUP BY "column" """,
        f"""SELECT concat('missing_patterns.', "column", '.sample'), CAST(NULL AS DOUBLE),
coalesce(string_agg(review_id, ', ' ORDER BY position), '') FROM {listed} GROUP BY "column" """,
    ]
    alert = _alert_row(source)
    rows += [
        _number("total_outliers", f"(SELECT total_outliers FROM ({alert}))"),
        _number("pattern_types", f"(SELECT pattern_types FROM ({alert}))"),
        _label("alert", f"(SELECT alert FROM ({alert}))"),
    ]
    return "\nUNION ALL\n".join(rows)


# Generators.

_SEED = 42


def _u(name: str, row_id: str = "CAST(id AS VARCHAR)") -> str:
    return (
        f"(CAST(CAST(concat('0x', substr(md5(concat_ws('|', '{_SEED}', {row_id}, '{name}')), 1, 13))"
        " AS BIGINT) AS DOUBLE) / 4503599627370496)"
    )


def _int(u: str, low: int, high: int) -> str:
    return f"(CAST(floor({u} * {high - low + 1}) AS BIGINT) + {low})"


def _choice(u: str, values: tuple) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{listed}])[{_int(u, 1, len(values))}]"


def _poisson(name: str, rate: float) -> str:
    """The number of cumulative probabilities at or below the draw, summed here term by term."""
    terms = f"list_transform(range(0, 40), lambda k: exp(-{rate}) * pow({rate}, k) / factorial(CAST(least(k, 30) AS INTEGER)))"
    upto = f"list_transform(range(1, 31), lambda n: list_sum(list_slice({terms}, 1, n)))"
    return f"CAST(len(list_filter({upto}, lambda step: step <= {_u(name)})) AS BIGINT)"


def _lowest(name: str, fraction: float) -> str:
    return (
        f"SELECT id FROM (SELECT id, row_number() OVER (ORDER BY {_u(name)}, id) AS place,"
        f" count(*) OVER () AS n FROM ids) WHERE place <= floor({fraction}::DOUBLE * n)"
    )


_IDS = "WITH ids AS (SELECT o_orderkey AS id FROM orders)\n"


def _synthetic(profile: str) -> str:
    shape = gen.PROFILES[profile]
    by_rating = [shape.templates[rating] for rating in sorted(shape.templates)]
    quoted = ", ".join(
        "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in templates) + "]"
        for templates in by_rating
    )
    text = f"([{quoted}])[rating][{_int(_u('template'), 1, len(by_rating[0]))}]"
    for slot, words in shape.words.items():
        text = f"replace({text}, '{{{slot}}}', {_choice(_u(slot), words)})"
    votes = {name: _poisson(name, rate) for name, rate in gen.VOTE_RATES.items()}
    moment = "TIMESTAMP '2025-01-01 12:00:00'"
    if shape.extended:
        value = _int(_u("outlier_value", "'0'"), 100, 500)
        votes["useful_votes"] = (
            f"CASE WHEN id IN ({_lowest('outlier', gen.OUTLIER_SHARE)}) THEN {value}"
            f" ELSE {votes['useful_votes']} END"
        )
    extra = f""",
  strftime({moment}, '%H:%M:%S') AS time,
  CASE WHEN {_u('has_response_time')} > 0.7
       THEN CAST({_int(_u('response_hours'), 1, 168)} AS DOUBLE) END AS response_time_hours,
  {_u('verified_purchase')} > 0.2 AS verified_purchase, 'en' AS language"""
    return f"""{_IDS.strip()},
rated AS (SELECT id, CAST({_choice(_u('rating'), gen.RATING_SLOTS)} AS BIGINT) AS rating FROM ids),
written AS (SELECT id, rating, {text} AS full_text FROM rated)
SELECT printf('R%06d', id) AS review_id,
  printf('B%04d', {_int(_u('business_id'), 1, 100)}) AS business_id,
  printf('U%05d', {_int(_u('user_id'), 1, 1000)}) AS user_id,
  CASE WHEN id NOT IN ({_lowest('null_text', gen.NULL_TEXT_SHARE)}) THEN full_text END AS text,
  rating,
  strftime(CAST({moment} AS DATE) - CAST({_int(_u('date'), 0, 365)} AS INTEGER), '%Y-%m-%d')
    AS date,
  {', '.join(f'{sql} AS {name}' for name, sql in votes.items())},
  CAST(length(full_text) AS BIGINT) AS text_length,
  {_choice(_u('business_category'), gen.CATEGORIES)} AS business_category,
  {_u('has_owner_response')} > 0.7 AS has_owner_response,
  {_choice(_u('platform'), shape.platforms)} AS platform,
  CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END
    AS sentiment_label{extra if shape.extended else ''}
FROM written"""


def _null_token(column: str) -> str:
    tokens = ", ".join(f"'{token}'" for token in NA_TOKENS)
    return f"CASE WHEN {column} IN ({tokens}) THEN NULL ELSE {column} END"


_CSV_REVIEWS = f"""
SELECT * REPLACE ({_null_token('text')} AS text, strftime(date, '%Y-%m-%d') AS date,
  CAST(rating AS DOUBLE) AS rating) FROM reviews"""

_CLEAN_ROUNDED = "SELECT * REPLACE (round(rating, 6) AS rating) FROM clean"


def _rich(source: str) -> str:
    return f"""
SELECT *, {_r('list_avg(list_transform(string_split(cleaned_text, chr(32)), lambda w: length(w)))')}
    AS avg_word_length,
  {_r(f'(useful_votes - (SELECT avg(useful_votes) FROM {source})) / nullif((SELECT stddev_samp(useful_votes) FROM {source}), 0)')}
    AS useful_votes_normalized
FROM {source}"""


_CLEAN_COLUMNS = (*_REVIEW_COLUMNS, "cleaned_text", "word_count")


def oracle_sql() -> dict[str, str]:
    id_user = "review_id, user_id"
    names = ", ".join(_REVIEW_COLUMNS)
    clean_names = ", ".join(_CLEAN_COLUMNS)
    return {
        "read_reviews_csv": _with("reviews", _CSV_REVIEWS),
        "read_reviews_csv_split": _with("reviews", _CSV_REVIEWS),
        "acquire_reviews": "SELECT * FROM conversations",
        "acquire_local": _with("reviews", _CSV_REVIEWS),
        "acquire_table": _with("order_reviews", "SELECT * FROM order_reviews"),
        "acquire_profile": _with("reviews", f"""
SELECT count(*) AS rows, CAST({len(_REVIEW_COLUMNS)} AS BIGINT) AS columns,
  '{names}' AS column_names,
  {' + '.join(f'(count(*) - count({c}))' for c in _REVIEW_COLUMNS)} AS null_cells
FROM reviews"""),
        "synth_reviews_basic": _synthetic("basic"),
        "synth_reviews_extended": _synthetic("extended"),
        "synth_votes": _IDS + "SELECT id, " + ", ".join(
            f"{_poisson(name, rate)} AS {name}" for name, rate in gen.VOTE_RATES.items()
        ) + " FROM ids",
        "synth_null_injection": _IDS + _lowest("null_text", gen.NULL_TEXT_SHARE),
        "synth_outlier_injection": _IDS + _lowest("outlier", gen.OUTLIER_SHARE),
        "sample_head": _with("reviews", """
SELECT * FROM reviews ORDER BY review_id NULLS LAST, user_id NULLS LAST, date NULLS LAST,
  text NULLS LAST LIMIT 100"""),
        "dataset_stats": _with("reviews", f"""
SELECT count(*) AS reviews, min(date) AS first_date, max(date) AS last_date,
  count(DISTINCT business_id) AS businesses, count(DISTINCT user_id) AS users,
  {_r('avg(text_length)')} AS mean_text_length,
  {_r('avg(CAST(has_owner_response AS INTEGER))')} AS response_rate FROM reviews"""),
        "rating_counts": _with("reviews", """
SELECT rating, count(*) AS reviews FROM reviews WHERE rating IS NOT NULL GROUP BY rating"""),
        "write_clean": _with("clean", f"""
SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date, {_null_token('text')} AS text,
  round(rating, 6) AS rating, {_null_token('cleaned_text')} AS cleaned_text) FROM clean"""),
        "validation_json": _with("reviews_dup", f"""
SELECT CAST(count(*) AS VARCHAR) AS total_records, CAST(max(rating) AS VARCHAR) AS rating_max,
  {_truth('min(rating) >= 1 AND max(rating) <= 5')} AS rating_valid,
  CAST(count(*) - count(text) AS VARCHAR) AS missing_text,
  CAST({_members('reviews_dup', names)} AS VARCHAR) AS exact_duplicates,
  {_truth(_issues('reviews_dup', _REVIEW_COLUMNS) + " = ''")} AS validation_passed
FROM reviews_dup"""),
        "bias_report": _with("reviews", _bias_report("reviews")),
        "clean_text": _with(
            "reviews", f"SELECT review_id, {_clean('text')} AS cleaned_text FROM reviews"
        ),
        "clean_text_html": f"SELECT page_id, {_clean('html', True)} AS cleaned_text FROM pages",
        "clean_text_conversations":
            f"SELECT conv_id, turn, {_clean('text')} AS cleaned_text FROM conversations",
        "drop_empty_text": _with(
            "worded", f"SELECT {id_user}, cleaned_text FROM worded WHERE cleaned_text <> ''"
        ),
        "text_stats": _with("worded", f"""
SELECT {id_user}, CAST(length(cleaned_text) AS BIGINT) AS text_length,
  {_words('cleaned_text')} AS word_count FROM worded"""),
        "avg_word_length": _with("worded", f"""
SELECT {id_user}, {_r("CASE WHEN cleaned_text = '' THEN 0 ELSE list_avg(list_transform("
                      "string_split(cleaned_text, ' '), lambda w: length(w))) END")}
  AS avg_word_length FROM worded"""),
        "fill_text": _with("reviews", f"SELECT {id_user}, coalesce(text, '') AS text FROM reviews"),
        "impute_rating": _with("reviews", f"""
SELECT {id_user}, date,
  {_r('coalesce(rating, (SELECT median(rating) FROM reviews))')} AS rating FROM reviews"""),
        "fill_votes": _with("reviews", f"""
SELECT {id_user}, coalesce(useful_votes, 0) AS useful_votes,
  coalesce(funny_votes, 0) AS funny_votes, coalesce(cool_votes, 0) AS cool_votes FROM reviews"""),
        "drop_null_ids": _with("reviews", "SELECT * FROM reviews WHERE review_id IS NOT NULL"),
        "handle_missing_values": _with("reviews", _filled("reviews")),
        "normalize_votes": _with(
            "clean",
            f"SELECT {id_user}, useful_votes, useful_votes_normalized FROM ({_rich('clean')})",
        ),
        "length_filter": _with("clean", f"""
SELECT * EXCLUDE (text, cleaned_text) FROM ({_CLEAN_ROUNDED})
WHERE text_length BETWEEN 10 AND 5000"""),
        "drop_duplicate_ids": _with("reviews_dup", f"""
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY text NULLS FIRST,
    {', '.join(f'{c} NULLS FIRST' for c in _REVIEW_COLUMNS if c not in ('review_id', 'text'))})
    AS place
  FROM reviews_dup WHERE review_id IS NOT NULL) WHERE place = 1"""),
        "preprocess": _with("clean", _CLEAN_ROUNDED),
        "preprocess_rich": _with(
            "reviews",
            f"SELECT * FROM (WITH rich AS ({_cleaned('reviews', True)}) {_rich('rich')})",
        ),
        "temporal_features": _with("reviews", f"SELECT {id_user}, date, {_TEMPORAL} FROM reviews"),
        "temporal_features_orders": _with(
            "order_reviews", f"SELECT review_id, date, {_TEMPORAL} FROM order_reviews"
        ),
        "rating_flags": _with("reviews", f"SELECT {id_user}, rating, {_FLAGS} FROM reviews"),
        "lexicon_counts": _with("worded", f"SELECT {id_user}, {_LEXICON} FROM worded"),
        "lexicon_counts_conversations": f"""
SELECT conv_id, turn, {_LEXICON}
FROM (SELECT conv_id, turn, {_clean('text')} AS cleaned_text FROM conversations)""",
        "sentiment_score": _with("worded", f"""
SELECT {id_user}, positive_word_count - negative_word_count AS sentiment_score
FROM (SELECT {id_user}, {_LEXICON} FROM worded)"""),
        "interaction_features": _with("clean", f"SELECT {id_user}, {_INTERACTION} FROM clean"),
        "sentiment_label": _with("reviews", f"""
SELECT {id_user}, rating, CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2
  THEN 'negative' ELSE 'neutral' END AS sentiment_label FROM reviews"""),
        "business_stats": _with("reviews", _business_stats("reviews")),
        "business_stats_orders": _with("order_reviews", _business_stats("order_reviews")),
        "business_features": _with(
            "reviews",
            _business_features("reviews", "reviews.* EXCLUDE (text)"),
        ),
        "business_features_orders": _with(
            "order_reviews", _business_features("order_reviews", "order_reviews.*")
        ),
        "features": _with("clean", _features_of("clean")),
        "check_types": _with("reviews", _check_types("reviews")),
        "range_rating": _with("reviews", _range_rating("reviews")),
        "range_text_length": _with("reviews", _range_lengths("reviews")),
        "range_votes": _with("reviews", _range_votes("reviews")),
        "missing_report": _with("reviews", _missing("reviews", _REVIEW_COLUMNS)),
        "duplicate_counts": _with("reviews_dup", _duplicate_counts("reviews_dup")),
        "validation_verdict": _with("reviews_dup", _verdict("reviews_dup")),
        "validation_report": _with(
            "reviews_dup", _validation_report("reviews_dup", _REVIEW_COLUMNS)
        ),
        "rating_distribution": _with("reviews", _rating_distribution("reviews")),
        "rating_distribution_orders": _with(
            "order_reviews", _rating_distribution("order_reviews")
        ),
        "rating_summary": _with("reviews", _rating_summary("reviews")),
        "rating_summary_orders": _with("order_reviews", _rating_summary("order_reviews")),
        "rating_bias_verdict": _with("reviews", f"""
SELECT {_r('positive_ratio')} AS positive_ratio, {_r('negative_ratio')} AS negative_ratio,
  {_r('neutral_ratio')} AS neutral_ratio, {_VERDICT} AS bias_detected
FROM (SELECT {_RATIOS} FROM reviews)"""),
        "bias_recommendations": _with("reviews", _recommendations("reviews")),
        "category_bias": _with("reviews", _category_bias("reviews", "business_category")),
        "category_bias_orders": _with(
            "order_reviews", _category_bias("order_reviews", "business_category")
        ),
        "platform_bias": _with("reviews", _category_bias("reviews", "platform")),
        "category_bias_labels": _category_bias("labels", "quality", "toxic"),
        "category_imbalance": _with("reviews", _imbalance("reviews", "business_category")),
        "platform_imbalance": _with("reviews", _imbalance("reviews", "platform")),
        "monthly_trend": _with("reviews", _monthly("reviews")),
        "monthly_trend_orders": _with("order_reviews", _monthly("order_reviews")),
        "length_bias": _with("clean", _length_bias("clean")),
        "length_rating_corr": _with("reviews", _correlation("reviews")),
        "bias_analysis": _with("reviews", _bias_analysis("reviews")),
        "outliers_iqr": _with("reviews", _iqr("reviews", "useful_votes", f"{id_user}, useful_votes")),
        "outliers_iqr_lengths": _with(
            "reviews", _iqr("reviews", "text_length", f"{id_user}, text_length")
        ),
        "outliers_iqr_events": _iqr(
            "events", "value", f"event_id, user_id, {_r('value')} AS value"
        ),
        "outliers_iqr_orders": _with(
            "order_reviews", _iqr("order_reviews", "useful_votes", "order_reviews.*", 0.5)
        ),
        "outliers_zscore": _with("reviews", _z("reviews", "useful_votes", f"{id_user}, useful_votes")),
        "outliers_zscore_events": _z(
            "events", "value", f"event_id, user_id, {_r('value')} AS value"
        ),
        "outlier_counts": _with("reviews", _outlier_counts("reviews")),
        "duplicate_rows": _with("reviews_dup", _duplicate_rows("reviews_dup")),
        "suspicious_short": _with("clean", _first_ids(_SHORT.format(source="clean"))),
        "suspicious_votes": _with("reviews", _first_ids(_ODD_VOTES.format(source="reviews"))),
        "repeated_reviews": _with(
            "reviews", f"SELECT {_repeated('reviews')} AS repeated_groups"
        ),
        "suspicious_summary": _with("reviews", _suspicious("reviews")),
        "missing_patterns": _with("reviews", _missing_patterns("reviews")),
        "anomaly_alert": _with("reviews_dup", _alert_row("reviews_dup")),
        "anomaly_report": _with("reviews_dup", _anomaly_report("reviews_dup")),
        "job_summary": _with("clean_dup", _job_summary(features=True)),
        "common_users_events": """
SELECT user_id AS value, count(*) AS rows FROM events WHERE user_id IS NOT NULL GROUP BY user_id
HAVING count(*) > CAST(0.0005 AS DOUBLE) * (SELECT count(user_id) FROM events)""",
        "common_category_bias_orders": _with("order_reviews", _category_bias("""(
SELECT rating, CASE
  WHEN count(*) OVER (PARTITION BY business_id) > CAST(0.001 AS DOUBLE) * count(business_id) OVER ()
    THEN CAST(business_id AS VARCHAR)
  WHEN business_id IS NOT NULL THEN '(other)' END AS business_id FROM order_reviews)""", "business_id")),
        "job_resumed": _with("clean_dup", _job_summary(features=True)),
        "history_duplicate_counts": _with("reviews_dup", _duplicate_counts("reviews_dup")),
        "history_repeats": _with("reviews_dup", " UNION ALL ".join(
            f"""
SELECT review_id, '{name}' AS duplicate_set, here AS rows_here, every - here AS rows_before FROM (
  SELECT review_id, cool_votes, count(*) OVER (PARTITION BY {key}) AS every,
    count(*) OVER (PARTITION BY cool_votes, {key}) AS here FROM reviews_dup)
WHERE cool_votes = 3 AND every > 1"""
            for name, key in (
                ("review_id", "review_id"), ("text", "text"), ("all_columns", ", ".join(_REVIEW_COLUMNS))
            )
        )),
        "stream_distinct_ids": _with("reviews_dup", """
SELECT DISTINCT review_id, false AS undated FROM reviews_dup WHERE review_id IS NOT NULL AND date IS NOT NULL
UNION ALL
SELECT review_id, date IS NULL AS undated FROM reviews_dup WHERE review_id IS NULL OR date IS NULL"""),
        "job_short": _with("clean_dup", _job_summary(features=False)),
        "job_features": _with("clean_dup", _features_of("clean_dup")),
        "job_anomalies": _with("clean_dup", f"""
SELECT CAST(total_outliers AS VARCHAR) AS total_outliers,
  CAST(exact_duplicates AS VARCHAR) AS exact_duplicates, alert,
  (SELECT min(review_id) FROM ({_duplicate_rows('clean_dup', _CLEAN_COLUMNS)})
   WHERE duplicate_set = 'all_columns') AS first_exact_duplicate
FROM ({_alert_row('clean_dup', _CLEAN_COLUMNS)})"""),
        "job_bias": _with("clean_dup", _bias_analysis("clean_dup")),
        "job_outliers": _with("clean_dup", _outlier_rows("clean_dup")),
        "sketched_events": """
SELECT CAST(share AS DOUBLE) AS share, count(value) AS n, true AS within
FROM events, (VALUES (0.25), (0.5), (0.75)) AS v(share) GROUP BY share""",
        "stream_column_checks": _with("reviews", _column_checks("reviews")),
        "stream_rating_distribution": _with("reviews", f"""
SELECT CAST(rating AS DOUBLE) AS rating, share FROM ({_rating_distribution("reviews")})"""),
        "stream_rating_summary": _with("reviews", _rating_summary("reviews")),
        "stream_category_bias": _with("reviews", _category_bias("reviews", "business_category")),
        "parts_monthly_trend_orders": _with("order_reviews", _monthly("order_reviews")),
        "parts_business_stats_orders": _with("order_reviews", f"""
SELECT * EXCLUDE (business_total_useful_votes) REPLACE (CAST(business_id AS VARCHAR) AS business_id)
FROM ({_business_stats("order_reviews")})"""),
    }


def _job_summary(features: bool) -> str:
    shown = f"CAST({len(_CLEAN_COLUMNS) + 16} AS BIGINT) AS feature_columns," if features else ""
    return f"""
SELECT (SELECT count(*) FROM clean_dup) AS clean_reviews, {shown}
  validation_passed, issues, total_outliers, pattern_types, alert,
  (SELECT {_VERDICT} FROM (SELECT {_RATIOS} FROM clean_dup)) AS bias_detected
FROM ({_verdict('clean_dup', _CLEAN_COLUMNS)}), ({_alert_row('clean_dup', _CLEAN_COLUMNS)})"""


def _features_of(source: str) -> str:
    shown = f"{source}.* REPLACE (round(rating, 6) AS rating), {_TEMPORAL}, {_FLAGS}, {_LEXICON}, {_INTERACTION}"
    return f"""
SELECT *, positive_word_count - negative_word_count AS sentiment_score FROM (
{_business_features(source, shown)})"""
