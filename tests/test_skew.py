"""One subject holds a third of all rows: results must stay exact."""
import datetime as dt
import random

from cohortlab import operators as op


def test_hot_subject_latest_episode_and_notes(spark):
    rnd = random.Random(5)
    base = dt.datetime(2000, 1, 1)
    eps, notes = [], []
    stay = 0
    for pid in range(1, 61):
        n_ep = 60 if pid == 1 else 2          # subject 1: half of all episodes
        for _ in range(n_ep):
            stay += 1
            i = base + dt.timedelta(days=rnd.randint(0, 3000))
            o = i + dt.timedelta(days=rnd.randint(1, 30))
            eps.append((pid, stay, stay, i, o))
    ep = spark.createDataFrame(eps, "pid long, hadm long, stay long, in_ts timestamp, out_ts timestamp")
    subj = spark.createDataFrame([(p, 0, dt.datetime(1950, 1, 1), 0, dt.datetime(9000, 1, 1),
                                   dt.datetime(1971, 1, 1), 0.0) for p in range(1, 61)],
                                 "pid long, is_male int, dob timestamp, is_dead int, dod timestamp, "
                                 "index_date timestamp, age double")
    latest = {}
    for p, h, s, i, o in eps:
        if p not in latest or (o, s) > (latest[p][4], latest[p][2]):
            latest[p] = (p, h, s, i, o)
    got = {r["pid"]: r["stay"] for r in op.latest_episode(ep).collect()}
    assert got == {p: v[2] for p, v in latest.items()}

    cohort = op.build_cohort(subj, ep.repartition(7))
    for p, h, s, i, o in latest.values():
        k = 400 if p == 1 else 8               # subject 1: most notes
        for j in range(k):
            t = i + dt.timedelta(hours=rnd.randint(-48, (o - i).days * 24 + 48))
            notes.append((p, h, t, "alpha beta gamma delta " * (1 + j % 3)))
    nt = spark.createDataFrame(notes, "pid long, hadm long, ts timestamp, text string").repartition(5)
    inside = [(p, t, x) for p, h, t, x in notes if latest[p][3] <= t < latest[p][4]]
    inep = op.notes_in_episode(cohort, nt)
    assert inep.count() == len(inside)
    words = {r["pid"]: r["n_words"] for r in op.words_per_subject(op.tokenize(inep, "text", [])).collect()}
    exp = {}
    for p, t, x in inside:
        exp[p] = exp.get(p, 0) + len(x.split())
    assert words == exp
    nc = op.note_cohort(cohort, nt, [], min_words=100)
    firsts = {r["pid"]: r["first_ts"] for r in nc["first"].collect()}
    for p, n in exp.items():
        if n >= 100:
            assert firsts[p] == min(t for q, t, _ in inside if q == p)
        else:
            assert p not in firsts


def test_hot_admission_is_spread_over_time_bins(spark):
    """A third of all notes in one admission: the same rows, dealt evenly."""
    from pyspark.sql import functions as F
    rnd = random.Random(9)
    base = dt.datetime(2000, 1, 1)
    rows = [(p, p, p, base, base + dt.timedelta(days=400) if p % 4 else dt.datetime(9000, 1, 1),
             dt.datetime(9000, 1, 1) if p % 3 else base + dt.timedelta(days=300)) for p in range(1, 40)]
    cohort = spark.createDataFrame(rows, "pid long, hadm long, stay long, in_ts timestamp, out_ts timestamp, dod timestamp")
    notes = [(rnd.randrange(1, 45), base + dt.timedelta(hours=rnd.randrange(-500, 12_000))) for _ in range(4000)]
    notes += [(4, base + dt.timedelta(hours=rnd.randrange(-500, 12_000))) for _ in range(2000)]
    nt = spark.createDataFrame([(p, p, t, i) for i, (p, t) in enumerate(notes)], "pid long, hadm long, ts timestamp, i long").repartition(6)
    want = sorted(map(tuple, op.notes_in_episode(cohort, nt, carry="c").collect()))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                                "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = op.notes_in_episode_binned(cohort, nt, bin_hours=240, hot_rows=500, carry="c")
        assert sorted(map(tuple, out.collect())) == want

        def fullest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            return max(sizes) / len(want)
        assert fullest(out.select("pid")) < 0.2 < fullest(op.notes_in_episode(cohort, nt).select("pid"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
