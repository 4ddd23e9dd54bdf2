import random

import pytest
from rows import actions, as_tuples

from clicktide.operators import skew
from clicktide.operators.pages import (
    page_convert_rate,
    page_jump_counts,
    page_jumps,
    page_steps,
    page_visit_counts,
)

FLOW = (1, 2, 3)


def _walk(spark):
    return actions(
        spark,
        {"page_id": 2, "action_time": "2024-01-01 00:00:10"},
        {"page_id": 1, "action_time": "2024-01-01 00:00:00"},
        {"page_id": 3, "action_time": "2024-01-01 02:00:00"},
        {"page_id": 1, "action_time": "2024-01-01 03:00:00"},
        {"page_id": 2, "action_time": "2024-01-01 03:00:00"},
        {"page_id": 1, "session_id": "t"},
        {"page_id": 9, "session_id": "t", "action_time": "2024-01-01 00:00:01"},
        {"page_id": 1, "session_id": "alone"},
    )


def test_visits_leave_out_the_last_page(spark):
    assert as_tuples(page_visit_counts(_walk(spark), FLOW)) == [(1, 4), (2, 2)]


def test_jumps_follow_time_then_seq(spark):
    jumps = as_tuples(page_jumps(_walk(spark)), "session_id", "page_jump")
    assert jumps == [("s", "1-2"), ("s", "1-2"), ("s", "2-3"), ("s", "3-1"), ("t", "1-9")]


def test_counts_and_rates(spark):
    assert as_tuples(page_jump_counts(_walk(spark), FLOW)) == [("1-2", 2), ("2-3", 1)]
    assert as_tuples(page_convert_rate(_walk(spark), FLOW, "t")) == [
        ("t", "1-2", 50.0), ("t", "2-3", 50.0),
    ]


def test_jump_that_never_occurs_has_no_row(spark):
    assert page_convert_rate(_walk(spark), (3, 9), "t").count() == 0


@pytest.fixture(params=[1, 3, 40])
def chunks(spark, request, monkeypatch):
    """More cuts with each value; nothing may rest on one shuffle being used twice."""
    monkeypatch.setattr(skew, "ROWS_PER_SAMPLE", 64 // request.param)
    monkeypatch.setattr(skew, "CHUNK", 40 // request.param)
    spark.conf.set("spark.sql.exchange.reuse", False)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.exchange.reuse")


def test_chunks_do_not_change_the_steps(spark, chunks):
    """One long session next to short ones, against a plain loop."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        session = "long" if i % 3 else f"s{rng.randrange(60)}"
        moment = rng.randrange(3000)
        rows.append(
            {
                "session_id": session, "page_id": rng.randrange(1, 5),
                "action_time": f"2024-01-01 {moment // 3600:02}:{moment // 60 % 60:02}"
                f":{moment % 60:02}",
            }
        )
    expected = []
    ordered = sorted(
        (r["session_id"], r["action_time"], seq, r["page_id"]) for seq, r in enumerate(rows)
    )
    for here, after in zip(ordered, ordered[1:] + [("", "", 0, 0)]):
        same = here[0] == after[0]
        expected.append((here[0], here[2], here[3], after[3] if same else None))
    steps = page_steps(actions(spark, *rows))
    got = as_tuples(steps, "session_id", "tie", "page_id", "next_page_id")
    assert got == sorted(expected, key=repr)


def test_actions_without_a_readable_time_are_steps(spark, chunks):
    """They come first, in the order of the table, and end nothing."""
    times = ["no time", "", "2024-01-01 00:00:03", "2024-01-01 00:00:04", "2024-01-01 00:00:05"]
    frame = actions(spark, *[{"page_id": i + 1, "action_time": t, "date": "2024-01-01"} for i, t in enumerate(times)])
    assert as_tuples(page_jumps(frame), "page_jump") == [("1-2",), ("2-3",), ("3-4",), ("4-5",)]
    none = actions(spark, *[{"page_id": p, "action_time": "x", "date": "2024-01-01"} for p in (1, 2, 1, 2)])
    assert as_tuples(page_jump_counts(none, FLOW)) == [("1-2", 2)]
    assert as_tuples(page_convert_rate(none, FLOW, "t")) == [("t", "1-2", 100.0)]


def test_a_session_within_one_second(spark, chunks):
    frame = actions(spark, *[{"page_id": i % 7 + 1} for i in range(500)])
    want = [f"{i % 7 + 1}-{(i + 1) % 7 + 1}" for i in range(499)]
    jumps = dict(as_tuples(page_jumps(frame), "seq", "page_jump"))
    assert [jumps[i] for i in range(499)] == want
