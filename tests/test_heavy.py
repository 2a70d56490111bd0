from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from revaudit.operators import bias, heavy


@pytest.fixture(scope="module")
def visits(spark):
    """60,000 rows: a third of one value, twenty of 600 to 790, the rest once or twice each, some null."""
    n = F.col("id")
    user = (
        F.when(n % 3 == 0, "hot")
        .when(n < 45_000, F.concat(F.lit("u"), (F.pmod(F.xxhash64("id"), F.lit(20_000))).cast("string")))
        .when(n % 97 == 1, None)
        .otherwise(F.concat(F.lit("c"), F.floor(F.sqrt((n - 45_000) / 40)).cast("string")))
    )
    return spark.range(60_000).select(user.alias("user"), (n % 5).alias("rating"), (n % 4).alias("part"))


@pytest.fixture(scope="module")
def counts(visits):
    return Counter(r["user"] for r in visits.collect() if r["user"] is not None)


def test_every_value_above_the_share_is_found_and_counted(visits, counts):
    n = counts.total()
    assert len(counts) > 10_000
    for share in (0.2, 0.01, 0.005):
        assert heavy.tracked_for(share) < 2000  # far fewer than there are values
        found = heavy.common_values(visits, "user", share)
        want = {v: c for v, c in counts.items() if c > share * n}
        assert {r["value"]: r["rows"] for r in found.collect()} == want and want
    parted = heavy.summarise(visits, "user", heavy.tracked_for(0.01), ["part"])
    again = heavy.common_values(visits, "user", 0.01, parted)
    assert {r["value"]: r["rows"] for r in again.collect()} == {v: c for v, c in counts.items() if c > 0.01 * n}


def test_bounds_hold(visits, counts):
    for tracked in (64, 500):
        whole = heavy.united(heavy.summarise(visits, "user", tracked, ["part"]), tracked)
        held = {r["value"]: r for r in heavy.bounds(whole, tracked).collect()}
        assert len(held) <= tracked
        assert all(r["at_least"] <= counts[v] <= r["at_most"] for v, r in held.items())
        unseen = max(c for v, c in counts.items() if v not in held)
        assert unseen <= heavy.error_share(tracked) * counts.total()


def test_ranks_are_proved_or_marked(visits, counts):
    rows = heavy.most_common(visits, "user", 12, tracked=500).collect()
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    proved = [r for r in rows if r["proved"]]
    assert [(r["value"], r["rows"]) for r in proved] == best[: len(proved)] and len(proved) >= 5
    assert all(r["rows"] == counts[r["value"]] for r in rows)
    few = heavy.most_common(visits, "user", 12, tracked=64).collect()
    assert few[0]["proved"] and not few[-1]["proved"]


def test_others_bound_a_report(visits, counts):
    put = heavy.with_others(visits, "user", 0.01)
    assert put.columns == visits.columns and put.count() == 60_000
    table = {r["category"]: r["count"] for r in bias.category_bias(put, "user").collect()}
    want = {v: c for v, c in counts.items() if c > 0.01 * counts.total()}
    assert table.pop(heavy.OTHERS) == counts.total() - sum(want.values())
    assert table.pop(None) == 0 and table == want


def test_empty_and_bad_shares(spark, visits):
    none = visits.filter("user IS NULL")
    assert heavy.common_values(none, "user", 0.01).count() == 0
    assert heavy.most_common(none, "user", 3).count() == 0
    assert heavy.with_others(none, "user", 0.5).count() == none.count() > 0
    for share in (0, 1.5, 1e-7):
        with pytest.raises(ValueError):
            heavy.tracked_for(share)
