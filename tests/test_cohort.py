from cohortlab import operators as op
from helpers import collect_sorted, episodes, notes, subjects


def test_latest_episode_ties_broken_by_stay(spark):
    ep = episodes(spark, [(1, 10, 100, "2000-01-01", "2000-02-01"), (1, 11, 101, "2000-01-05", "2000-02-01"),
                          (1, 12, 99, "1999-01-01", "1999-02-01"), (2, 20, 200, "2000-01-01", "2000-01-03")])
    got = collect_sorted(op.latest_episode(ep), "pid", "stay")
    assert got == [(1, 101), (2, 200)]


def test_age_cap_and_adult_filter(spark):
    # in 2000-01-01; dob chosen to give ages ~17.999, 18.0, 299.9, 300.0, 89.5
    import datetime as dt
    base = dt.datetime(2000, 1, 1)
    year_ms = 31_536_000_000

    def dob(age):
        return (base - dt.timedelta(milliseconds=round(age * year_ms))).strftime("%Y-%m-%d %H:%M:%S")
    ages = {1: 17.999, 2: 18.0, 3: 299.9, 4: 300.0, 5: 89.5}
    subj = subjects(spark, [(p, 0, dob(a), None) for p, a in ages.items()])
    ep = episodes(spark, [(p, p, p, "2000-01-01 00:00:00", "2000-02-01") for p in ages])
    got = dict(collect_sorted(op.build_cohort(subj, ep), "pid", "age"))
    assert 1 not in got
    assert abs(got[2] - 18.0) < 1e-9
    assert abs(got[3] - 299.9) < 1e-6
    assert got[4] == 89.0
    assert abs(got[5] - 89.5) < 1e-9


def _cohort(spark):
    subj = subjects(spark, [(1, 1, "1950-01-01", None), (2, 0, "1950-01-01", "2000-01-10 00:00:00"),
                            (3, 0, "1950-01-01", "2000-02-01 00:00:00"),
                            (4, 0, "1950-01-01", "2000-03-02 00:00:00"),
                            (5, 0, "1950-01-01", "2000-03-03 00:00:00"),
                            (6, 0, "1950-01-01", "2000-01-01 00:00:00"),
                            (7, 0, "1950-01-01", "2000-02-01 00:00:00.001"[:19])])
    ep = episodes(spark, [(p, p, p, "2000-01-01", "2000-02-01") for p in range(1, 8)]
                  + [(8, 8, 8, "2000-01-01", "9000-01-01")])
    subj8 = subjects(spark, [(8, 0, "1950-01-01", None)])
    return op.build_cohort(subj.unionByName(subj8), ep)


def test_labels_boundaries(spark):
    c = _cohort(spark)
    lab = {r["pid"]: (r["label_in_episode"], r["label_30d"], r["label_1y"]) for r in op.label_all(c).collect()}
    assert lab[1] == (0, 0, 0)          # alive, out before sentinel
    assert lab[2] == (1, 0, 0)          # died inside
    assert lab[3] == (1, 0, 0)          # dod == out counts as in-episode
    assert lab[4] == (0, 1, 1)          # 30 whole days after out
    assert lab[5] == (0, 0, 1)          # 31 days -> only 1 year
    assert lab[6] == (1, 0, 0)          # dod == in
    assert lab[8] == (1, 0, 0)          # missing out + alive share the sentinel (kept as in the study)
    fixed = {r["pid"]: r["label"] for r in
             op.label_events(c, "in_episode", sentinel_is_missing=True).collect()}
    assert fixed[8] == 0


def test_notes_in_episode_interval(spark):
    subj = subjects(spark, [(1, 0, "1950-01-01", "2000-01-20 00:00:00")])
    ep = episodes(spark, [(1, 10, 10, "2000-01-01", "2000-02-01")])
    c = op.build_cohort(subj, ep)
    n = notes(spark, [(1, 10, "2000-01-01 00:00:00", "at in"), (1, 10, "2000-01-05 00:00:00", "inside"),
                      (1, 10, "2000-01-20 00:00:00", "at dod"), (1, 10, "2000-02-01 00:00:00", "at out"),
                      (1, 11, "2000-01-05 00:00:00", "other admission")])
    assert collect_sorted(op.notes_in_episode(c, n), "text") == [("at in",), ("inside",)]


def test_present_after_hours_strict_and_zero(spark):
    subj = subjects(spark, [(1, 0, "1950-01-01", None), (2, 0, "1950-01-01", None)])
    ep = episodes(spark, [(1, 1, 1, "2000-01-01", "2000-01-02"), (2, 2, 2, "2000-01-01", "2000-01-03")])
    c = op.build_cohort(subj, ep)
    first = spark.createDataFrame([(1, __import__("helpers").ts("2000-01-01 00:00:00"))], "pid long, first_ts timestamp")
    assert collect_sorted(op.present_after_hours(c, first, 24), "pid") == []        # out == first + h dropped
    assert collect_sorted(op.present_after_hours(c, first, 23), "pid") == [(1,)]
    assert collect_sorted(op.present_after_hours(c, first, 0), "pid") == [(1,), (2,)]
    assert collect_sorted(op.present_after_hours(c, first, -5), "pid") == [(1,), (2,)]


def test_events_within_hours_and_survivors(spark):
    from helpers import ts
    first = spark.createDataFrame([(1, ts("2000-01-01 00:00:00")), (2, ts("2000-01-01 00:00:00"))],
                                  "pid long, first_ts timestamp")
    ev = notes(spark, [(1, 1, "2000-01-01 05:00:00", "a"), (1, 1, "2000-01-01 06:00:00", "b"),
                       (2, 2, "2000-01-01 01:00:00", "c"), (3, 3, "2000-01-01 01:00:00", "d")])
    assert collect_sorted(op.events_within_hours(ev, first, 6), "text") == [("a",), ("c",)]
    surv = spark.createDataFrame([(2,)], "pid long")
    assert collect_sorted(op.events_within_hours(ev, first, 6, survivors=surv), "text") == [("c",)]
    assert len(op.events_within_hours(ev, first, 0).collect()) == 4


def test_label_millisecond_and_year_boundaries(spark):
    import datetime as dt
    out = dt.datetime(2000, 1, 1)
    cases = {1: out + dt.timedelta(milliseconds=1),     # 30d and 1y
             2: out + dt.timedelta(days=365),           # 1y only (365 whole days)
             3: out + dt.timedelta(days=366),           # neither
             4: out + dt.timedelta(days=30, hours=23),  # still 30 whole days
             5: out}                                     # in episode only
    rows = [(p, dt.datetime(1999, 12, 1), out, d) for p, d in cases.items()]
    c = spark.createDataFrame(rows, "pid long, in_ts timestamp, out_ts timestamp, dod timestamp")
    got = {r["pid"]: (r["label_in_episode"], r["label_30d"], r["label_1y"]) for r in op.label_all(c).collect()}
    assert got == {1: (0, 1, 1), 2: (0, 0, 1), 3: (0, 0, 0), 4: (0, 1, 1), 5: (1, 0, 0)}
