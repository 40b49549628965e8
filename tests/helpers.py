import datetime as dt


def ts(s: str) -> dt.datetime:
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S") if len(s) > 10 else dt.datetime.strptime(s, "%Y-%m-%d")


def subjects(spark, rows):
    """rows: (pid, is_male, dob, dod or None)"""
    from cohortlab.constants import SENTINEL_TS
    data = [(p, m, ts(b), 1 if d else 0, ts(d) if d else ts(SENTINEL_TS), ts("1971-01-01"), 0.0)
            for p, m, b, d in rows]
    return spark.createDataFrame(
        data, "pid long, is_male int, dob timestamp, is_dead int, dod timestamp, index_date timestamp, age double")


def episodes(spark, rows):
    """rows: (pid, hadm, stay, in, out)"""
    return spark.createDataFrame([(p, h, s, ts(i), ts(o)) for p, h, s, i, o in rows],
                                 "pid long, hadm long, stay long, in_ts timestamp, out_ts timestamp")


def notes(spark, rows):
    """rows: (pid, hadm, ts, text)"""
    return spark.createDataFrame([(p, h, ts(t), x) for p, h, t, x in rows],
                                 "pid long, hadm long, ts timestamp, text string")


def collect_sorted(df, *cols):
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]
