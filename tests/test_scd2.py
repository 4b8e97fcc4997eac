"""SCD2 apply (MERGE semantics), history, late arrivals: hand-made cases."""

import pytest

from helpers import END, OPEN, D, dim, snap, versions
from starloom.operators import scd2

S = D(2020, 5, 1)


def base(spark):
    return dim(spark, [
        (1, "a", "u1", 10, "city_a", "SP", OPEN, END, True),
        (2, "b", "u2", 20, "city_b", "RJ", OPEN, END, True),
        (3, "c", "u3", None, None, "MG", OPEN, END, True),     # NULL geography and city
        (4, "d", "u4", 40, "old_d", "PR", OPEN, D(2019, 12, 31), False),  # history only, no current row
        (5, "e", "u5", 50, "city_e", "BA", OPEN, END, True),
    ])


def test_change_new_absent_unchanged(spark):
    s = snap(spark, [
        ("a", "u1", 10, "moved_a", "SP", S),     # city changed
        ("b", "u2", 20, "city_b", "RJ", S),      # unchanged
        ("f", "u6", 60, "city_f", "SC", S),      # new key
        # e absent from the snapshot
    ])
    out = scd2.apply_snapshot(base(spark), s)
    got = versions(out)
    assert ("a", "city_a", "SP", 10, OPEN, D(2020, 4, 30), False) in got
    assert ("a", "moved_a", "SP", 10, S, END, True) in got
    assert ("b", "city_b", "RJ", 20, OPEN, END, True) in got
    assert ("e", "city_e", "BA", 50, OPEN, END, True) in got          # absent stays current
    assert ("f", "city_f", "SC", 60, S, END, True) in got             # new key starts at snapshot
    assert len(got) == 7
    # new versions get keys after the largest one, in (id, date) order
    sk = {(r.customer_id, r.effective_date): r.customer_sk for r in out.collect()}
    assert sk[("a", S)] == 6 and sk[("f", S)] == 7 and sk[("a", OPEN)] == 1


def test_null_change_is_missed_by_default_and_caught_null_safe(spark):
    s = snap(spark, [("c", "u3", 30, "city_c", "MG", S)])  # NULL -> value for geography and city
    plain = versions(scd2.apply_snapshot(base(spark), s))
    assert [v for v in plain if v[0] == "c"] == [("c", None, "MG", None, OPEN, END, True)]
    safe = versions(scd2.apply_snapshot(base(spark), s, null_safe=True))
    assert [v for v in safe if v[0] == "c"] == [
        ("c", None, "MG", None, OPEN, D(2020, 4, 30), False),
        ("c", "city_c", "MG", 30, S, END, True),
    ]


def test_value_to_null_is_missed_by_default(spark):
    s = snap(spark, [("a", "u1", 10, None, "SP", S)])
    assert [v for v in versions(scd2.apply_snapshot(base(spark), s)) if v[0] == "a"] == [
        ("a", "city_a", "SP", 10, OPEN, END, True)
    ]


def test_history_only_key_is_inserted_again(spark):
    s = snap(spark, [("d", "u4", 40, "new_d", "PR", S)])
    got = [v for v in versions(scd2.apply_snapshot(base(spark), s)) if v[0] == "d"]
    assert got == [("d", "new_d", "PR", 40, S, END, True), ("d", "old_d", "PR", 40, OPEN, D(2019, 12, 31), False)]


def test_unique_id_alone_does_not_version(spark):
    s = snap(spark, [("a", "OTHER", 10, "city_a", "SP", S)])
    out = scd2.apply_snapshot(base(spark), s)
    r = out.filter("customer_id = 'a'").collect()
    assert len(r) == 1 and r[0].customer_unique_id == "u1"


def test_same_day_second_change_gives_empty_interval(spark):
    d1 = scd2.apply_snapshot(base(spark), snap(spark, [("a", "u1", 10, "x", "SP", S)]))
    d2 = scd2.apply_snapshot(d1, snap(spark, [("a", "u1", 10, "y", "SP", S)]))
    got = [v for v in versions(d2) if v[0] == "a"]
    assert ("a", "x", "SP", 10, S, D(2020, 4, 30), False) in got   # expiry before effective
    assert ("a", "y", "SP", 10, S, END, True) in got


def test_rerun_is_idempotent(spark):
    s = snap(spark, [("a", "u1", 10, "moved", "SP", S), ("f", "u6", 60, "city_f", "SC", S)])
    once = scd2.apply_snapshot(base(spark), s)
    twice = scd2.apply_snapshot(once, s)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_duplicate_snapshot_key_fails(spark):
    s = snap(spark, [("a", "u1", 10, "x", "SP", S), ("a", "u1", 10, "y", "SP", S)])
    with pytest.raises(ValueError, match="duplicate keys"):
        scd2.apply_snapshot(base(spark), s)


def test_merge_source_adds_forced_rows_for_changes(spark):
    s = snap(spark, [("a", "u1", 10, "moved", "SP", S), ("b", "u2", 20, "city_b", "RJ", S)])
    src = scd2.merge_source(s, base(spark)).collect()
    assert sorted((r.customer_id, r.force_insert) for r in src) == [("a", False), ("a", True), ("b", False)]


def test_version_history_orders_changed_keys(spark):
    out = scd2.apply_snapshot(base(spark), snap(spark, [("a", "u1", 10, "moved", "SP", S)]))
    h = scd2.version_history(out).collect()
    assert [(r.customer_id, r.effective_date) for r in h] == [("a", OPEN), ("a", S)]


def _obs(spark, rows):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_unique_id", T.StringType()),
        T.StructField("geography_sk", T.LongType()),
        T.StructField("customer_city", T.StringType()),
        T.StructField("customer_state", T.StringType()),
        T.StructField("obs_date", T.DateType()),
        T.StructField("obs_rank", T.LongType()),
    ])
    return spark.createDataFrame(rows, schema)


def test_late_arrival_lands_at_event_time(spark):
    log = _obs(spark, [
        ("a", "u1", 10, "c1", "SP", OPEN, 0),
        ("a", "u1", 10, "c3", "SP", D(2021, 1, 1), 1),
    ])
    dim0 = scd2.timeline(log)
    late = _obs(spark, [("a", "u1", 10, "c2", "SP", D(2020, 6, 1), 2)])
    out = scd2.rebuild_timeline(dim0, log, late)
    assert versions(out) == [
        ("a", "c1", "SP", 10, OPEN, D(2020, 5, 31), False),
        ("a", "c2", "SP", 10, D(2020, 6, 1), D(2020, 12, 31), False),
        ("a", "c3", "SP", 10, D(2021, 1, 1), END, True),
    ]


def test_late_arrival_equal_to_previous_adds_nothing(spark):
    log = _obs(spark, [("a", "u1", 10, "c1", "SP", OPEN, 0)])
    late = _obs(spark, [("a", "u1", 10, "c1", "SP", D(2020, 6, 1), 2)])
    out = scd2.rebuild_timeline(scd2.timeline(log), log, late)
    assert versions(out) == [("a", "c1", "SP", 10, OPEN, END, True)]


def test_timeline_matches_ordered_null_safe_snapshots(spark):
    """U1 (null-safe) over daily snapshots in order == U5 over the same
    snapshots in any arrival order."""
    days = [D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1)]
    states = {
        "a": [("c1", "SP"), ("c2", "SP"), ("c2", "SP")],
        "b": [("x", "RJ"), (None, "RJ"), ("x", "RJ")],
        "c": [("k", "MG"), ("k", "MG"), ("k", "BA")],
    }
    first = dim(spark, [(i + 1, k, "u", 1, v[0][0], v[0][1], days[0], END, True)
                        for i, (k, v) in enumerate(sorted(states.items()))])
    cur = first
    for n in (1, 2):
        s = snap(spark, [(k, "u", 1, v[n][0], v[n][1], days[n]) for k, v in states.items()])
        cur = scd2.apply_snapshot(cur, s, null_safe=True)
    obs_rows = [(k, "u", 1, v[n][0], v[n][1], days[n], n) for k, v in states.items() for n in range(3)]
    log = _obs(spark, [r for r in obs_rows if r[6] != 1])
    arrivals = _obs(spark, [r for r in obs_rows if r[6] == 1])
    rebuilt = scd2.rebuild_timeline(scd2.timeline(log), log, arrivals)
    assert versions(rebuilt) == versions(cur)
