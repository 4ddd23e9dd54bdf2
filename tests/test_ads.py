import random
from collections import Counter

import pytest
from rows import as_tuples, lines

from clicktide.operators import ads

CLICK = "user_id STRING, ads_id STRING, day STRING, batch BIGINT"
BASE = 1_544_609_883_741  # 2018-12-12 10:18:03.741 UTC


def replay(clicks, limit):
    """The rule applied batch by batch: accepted clicks, listed users, stored counts."""
    listed, stored, accepted = {}, Counter(), []
    for batch in sorted({c[3] for c in clicks}):
        open_clicks = [c for c in clicks if c[3] == batch and c[0] not in listed]
        accepted += open_clicks
        for key, n in Counter(c[:3] for c in open_clicks).items():
            if stored[key] >= limit:
                listed.setdefault(key[0], batch)
            else:
                stored[key] += n
    return accepted, listed, stored


def random_clicks(seed, n=400, batches=8):
    rng = random.Random(seed)
    user = lambda: "hot" if rng.random() < 1 / 3 else f"u{rng.randrange(12)}"
    days = ("2024-01-01", "2024-01-02")
    return [
        (user(), f"ad{rng.randrange(3)}", rng.choice(days), rng.randrange(batches)) for _ in range(n)
    ]


def test_parse(spark):
    row = ads.ads_log_parse(lines(spark, f"{BASE} north metro 3 4")).collect()[0]
    assert (row.area, row.city, row.user_id, row.ads_id) == ("north", "metro", "3", "4")
    assert (row.day, row.hour_min) == ("2018-12-12", "10:18")
    assert row.logdate.microsecond == 741000


@pytest.mark.parametrize(
    ("line", "good"),
    [
        (f"{BASE} a c u x", True),
        (f"{BASE} a c u x more", True),
        (f"-{BASE} a c u x", True),
        (f"{BASE} a c u", False),
        (f"{BASE} a c u ", False),
        (f"{BASE}  c u x", True),
        ("", False),
        ("abc a c u x", False),
        ("1.5 a c u x", False),
        (f" {BASE} a c u x", False),
        ("99999999999999999999 a c u x", False),
        ("9223372036854775807 a c u x", False),
        ("253402300800000 a c u x", False),
        ("253402300799999 a c u x", True),
        ("-62135596800000 a c u x", True),
        ("-62135596800001 a c u x", False),
    ],
)
def test_malformed_lines_go_aside(spark, line, good):
    frame = lines(spark, line)
    assert ads.ads_log_parse(frame).count() == int(good)
    assert as_tuples(ads.malformed_lines(frame)) == ([] if good else [(line,)])


def test_null_line_is_malformed(spark):
    frame = spark.createDataFrame([(None,)], "value STRING")
    assert ads.malformed_lines(frame).count() == 1


@pytest.mark.parametrize("limit", [1, 2, 3, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_closed_form_equals_replay(spark, seed, limit):
    clicks = random_clicks(seed)
    accepted, listed, stored = replay(clicks, limit)
    frame = spark.createDataFrame(clicks, CLICK)
    assert as_tuples(ads.user_blacklist(frame, limit)) == sorted(listed.items())
    assert as_tuples(ads.ads_log_filtered(frame, limit)) == sorted(accepted)
    assert as_tuples(ads.user_ads_count_perday(frame, limit)) == sorted(
        (*key, n) for key, n in stored.items()
    )


def test_listing_batch_still_passes_and_other_ads_still_count(spark):
    clicks = [("u", "a", "d", 0)] * 2 + [("u", "a", "d", 1), ("u", "b", "d", 1), ("u", "b", "d", 2)]
    frame = spark.createDataFrame(clicks, CLICK)
    assert as_tuples(ads.user_blacklist(frame, 2)) == [("u", 1)]
    assert ads.ads_log_filtered(frame, 2).count() == 4
    assert as_tuples(ads.user_ads_count_perday(frame, 2)) == [("u", "a", "d", 2), ("u", "b", "d", 1)]


def test_default_limit(spark):
    frame = spark.range(10_001).selectExpr(
        "'u' AS user_id", "'a' AS ads_id", "'d' AS day", "id AS batch"
    )
    assert as_tuples(ads.user_blacklist(frame)) == [("u", 10_000)]
    assert ads.user_blacklist(frame.where("batch < 10000")).count() == 0


def _counts(spark):
    rows = [
        ("n", "c1", "1", "d", 5), ("n", "c2", "1", "d", 4), ("n", "c1", "2", "d", 6),
        ("n", "c1", "3", "d", 6), ("n", "c1", "4", "d", 1), ("s", "c1", "4", "d", 1),
        ("n", "c1", "4", "e", 2),
    ]
    return spark.createDataFrame(
        rows, "area STRING, city STRING, ads_id STRING, day STRING, click_count BIGINT"
    )


def test_top3_sums_the_cities_first(spark):
    top = as_tuples(ads.top3_ads_per_day(ads.area_ads_day_count(_counts(spark))))
    assert top == [
        ("d", "n", '[{"1":9},{"2":6},{"3":6}]'), ("d", "s", '[{"4":1}]'), ("e", "n", '[{"4":2}]'),
    ]


def test_top3_by_city_may_repeat_an_ad(spark):
    top = as_tuples(ads.top3_ads_per_day(_counts(spark)))
    assert top[0] == ("d", "n", '[{"2":6},{"3":6},{"1":5}]')


def test_last_hour_is_open_at_its_begin(spark):
    minute = 60_000
    start = 1_704_067_200_000  # 2024-01-01 00:00 UTC
    offsets = {"a": [0, 60 * minute], "b": [1, 59 * minute, 59 * minute + 5], "c": [-minute]}
    texts = [f"{start + o} n c u {ad}" for ad, moments in offsets.items() for o in moments]
    clicks = ads.ads_log_parse(lines(spark, *texts))
    assert as_tuples(ads.last_hour_ads_click(clicks)) == [
        ("a", '[{"01:00":1}]'), ("b", '[{"00:00":1},{"00:59":2}]'),
    ]
    earlier = ads.last_hour_ads_click(clicks, "2024-01-01 00:00:00")
    assert as_tuples(earlier) == [("a", '[{"00:00":1}]'), ("c", '[{"23:59":1}]')]


def test_batches_of_the_clock(spark):
    clicks = ads.ads_log_parse(lines(spark, "4999 n c u 1", "5000 n c u 1", "-1 n c u 1"))
    assert [r[0] for r in as_tuples(ads.with_batch(clicks), "batch")] == [-1, 0, 1]
