import random
from collections import Counter
from math import floor

import pytest
from rows import actions, as_tuples, cities, products

from clicktide.functions.sql import register_functions
from clicktide.operators.areas import (
    area_product_click_count,
    area_product_click_detail,
    area_top3_product,
    city_remark,
)

COUNTED = "area STRING, city_name STRING, clicks BIGINT"


def _remark(spark, *counts, **options):
    frame = spark.createDataFrame([("x", city, n) for city, n in counts], COUNTED)
    return as_tuples(city_remark(frame, ["area"], **options))[0]


def test_two_cities_have_no_rest(spark):
    assert _remark(spark, ("a", 1), ("b", 2)) == ("x", 3, "b:66.7%,a:33.3%")


def test_three_cities_have_a_rest(spark):
    assert _remark(spark, ("a", 1), ("b", 2), ("c", 3)) == ("x", 6, "c:50.0%,b:33.3%,其他:16.7%")


def test_whole_percents_are_cut(spark):
    result = _remark(spark, ("a", 1), ("b", 2), ("c", 3), whole_percent=True)
    assert result == ("x", 6, "c:50.0%,b:33.0%,其他:17.0%")


def test_one_city(spark):
    assert _remark(spark, ("a", 4)) == ("x", 4, "a:100.0%")


def test_unnamed_cities_count_as_clicks_only(spark):
    assert _remark(spark, (None, 5), ("", 5), ("a", 1), ("b", 1)) == (
        "x", 12, "a:50.0%,b:50.0%"
    )
    assert _remark(spark, (None, 5), ("", 1)) == ("x", 6, "")


def test_ties_go_by_name(spark):
    assert _remark(spark, ("c", 1), ("b", 1), ("a", 1))[2] == "a:33.3%,b:33.3%,其他:33.4%"


@pytest.mark.parametrize("whole", [False, True])
def test_remark_against_a_loop(spark, whole):
    rng = random.Random(3)
    rows = [(f"g{rng.randrange(8)}", f"c{rng.randrange(5)}", rng.randrange(1, 40)) for _ in range(90)]
    got = dict(
        (r[0], r[2])
        for r in as_tuples(city_remark(spark.createDataFrame(rows, COUNTED), ["area"], whole))
    )
    for area in {r[0] for r in rows}:
        totals = Counter()
        for a, city, n in rows:
            if a == area:
                totals[city] += n
        whole_sum = sum(totals.values())
        best = sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:2]
        tenths = [floor(n / whole_sum * 1000 + 0.5) for _, n in best]
        if whole:
            tenths = [t // 10 * 10 for t in tenths]
        parts = [f"{city}:{t / 10}%" for (city, _), t in zip(best, tenths)]
        if len(totals) > 2:
            parts.append(f"其他:{(1000 - sum(tenths)) / 10}%")
        assert got[area] == ",".join(parts)


def _tables(spark):
    places = cities(spark, (1, "one", "n"), (2, "two", "n"), (3, "three", "s"))
    clicks = [(1, 7)] * 3 + [(2, 7)] + [(1, 8)] * 2 + [(1, 9)] * 2 + [(2, 6)] + [(3, 7)]
    clicks += [(99, 7), (1, 99), (1, -1)]
    table = actions(
        spark, *[{"city_id": c, "click_product_id": p, "click_category_id": 1} for c, p in clicks]
    )
    return table, places, products(spark, 6, 7, 8, 9)


def test_detail_drops_unknown_places_and_products(spark):
    assert area_product_click_detail(*_tables(spark)).count() == 10


def test_counts_equal_the_detail(spark):
    counts = area_product_click_count(*_tables(spark))
    detail = area_product_click_detail(*_tables(spark))
    expected = Counter((r.area, r.product_id) for r in detail.collect())
    assert {(r.area, r.product_id): r.clickcount for r in counts.collect()} == expected
    remarks = {(r.area, r.product_id): r.cityremark for r in counts.collect()}
    assert remarks[("n", 7)] == "one:75.0%,two:25.0%"


def test_ties_at_the_edge_are_all_kept(spark):
    frame = spark.createDataFrame(
        [("n", i, f"p{i}", n, "") for i, n in enumerate([9, 5, 4, 4, 4, 1])],
        "area STRING, product_id BIGINT, product_name STRING, clickcount BIGINT, cityremark STRING",
    )
    assert [r[1] for r in as_tuples(area_top3_product(frame))] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("rows", [
    [("a", 1), ("b", 2), ("c", 3)], [("a", 5)], [("a", 1), ("b", 1)], [("", 4), (None, 2), ("x", 3), ("y", 3)],
    [("", 4)], [(None, 1)], [("a", 7), ("b", 7), ("c", 7), ("d", 1)],
])
def test_city_remark_in_sql_equals_the_operator(spark, rows):
    register_functions(spark)
    frame = spark.createDataFrame([("n", *r) for r in rows], COUNTED)
    frame.createOrReplaceTempView("counted")
    found = spark.sql(
        "SELECT area, sum(clicks) AS clickcount, city_remark(collect_list(struct(city_name, clicks))) AS cityremark"
        " FROM counted GROUP BY area"
    )
    assert as_tuples(found) == as_tuples(city_remark(frame, ["area"]))
