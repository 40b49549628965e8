import os
import tempfile

from pyspark.sql import functions as F

from cohortlab.sources import (load_episodes, load_flags, load_notes, load_scores, load_subjects,
                               normalize_quoted_text, normalize_quoted_text_light, read_csv_table,
                               read_word_list, table_counts, table_name_from_path, write_text)


def test_table_name_from_path():
    assert table_name_from_path("data/PATIENTS.csv") == "PATIENTS"
    assert table_name_from_path("/x/y/notes") == "notes"
    assert table_name_from_path("a/b.txt") == "txt"
    assert table_name_from_path("dir/") == "dir/"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_roundtrip_typed_loaders(spark):
    d = tempfile.mkdtemp(prefix="cohortlab-csv-")
    _write(os.path.join(d, "PATIENTS.csv"),
           "SUBJECT_ID,GENDER,DOB,DOD,EXPIRE_FLAG\n1,M,1950-01-01 00:00:00,2001-01-01 00:00:00,1\n"
           "2,f,1960-01-01 00:00:00,,0\n3,m,1960-01-01 00:00:00,2001-01-01 00:00:00,0\n")
    p = load_subjects(read_csv_table(spark, os.path.join(d, "PATIENTS.csv"))).orderBy("pid").collect()
    assert [r["is_male"] for r in p] == [1, 0, 1]
    assert str(p[0]["dod"]).startswith("2001-01-01")
    assert str(p[1]["dod"]).startswith("9000-01-01") and str(p[2]["dod"]).startswith("9000-01-01")
    assert spark.sql("SELECT count(*) AS n FROM PATIENTS").first()["n"] == 3

    _write(os.path.join(d, "NOTEEVENTS.csv"),
           'SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,CATEGORY,DESCRIPTION,TEXT,STORETIME\n'
           '1,10,2000-01-01,,Nursing,d,"line one\nline ""two"", end",2000-01-01 05:00:00\n'
           '1,10,2000-01-02,,DISCHARGE summary,d,"x",\n'
           '1,,2000-01-03,,Nursing,d,"no admission",\n'
           '1,10,2000-01-04,2000-01-04 07:00:00,Nursing,d,"plain",\n'
           '1,10,2000-01-05,,Nursing,d,"date only",\n')
    raw = read_csv_table(spark, os.path.join(d, "NOTEEVENTS.csv"), multi_line=True)
    n = load_notes(raw).orderBy("ts").collect()
    assert len(n) == 3
    assert n[0]["text"] == 'line one\nline "two", end'
    assert str(n[0]["ts"]) == "2000-01-01 05:00:00"
    assert str(n[1]["ts"]) == "2000-01-04 07:00:00"
    assert str(n[2]["ts"]) == "2000-01-05 00:00:00"

    _write(os.path.join(d, "ICUSTAYS.csv"), "SUBJECT_ID,HADM_ID,ICUSTAY_ID,INTIME,OUTTIME\n1,10,100,2000-01-01 00:00:00,\n")
    e = load_episodes(read_csv_table(spark, os.path.join(d, "ICUSTAYS.csv"))).first()
    assert str(e["out_ts"]).startswith("9000-01-01")

    _write(os.path.join(d, "SAPSII.csv"), "subject_id,hadm_id,icustay_id,sapsii,sapsii_prob\n1,10,100,,0.5\n")
    s = load_scores(read_csv_table(spark, os.path.join(d, "SAPSII.csv")), score_cols=["sapsii", "sapsii_prob"]).first()
    assert s["score"] == 0.0 and s["sapsii_prob"] == 0.5

    _write(os.path.join(d, "EHCOMORBIDITIES.csv"), "subject_id,hadm_id,a,b,c\n1,10,1,,0\n")
    f = load_flags(read_csv_table(spark, os.path.join(d, "EHCOMORBIDITIES.csv")), flag_cols=["a", "b", "c"]).first()
    assert f["flags"] == [1.0, 0.0, 0.0]

    counts = {r["table"]: r["n"] for r in table_counts({"p": raw, "q": raw.limit(1)}).collect()}
    assert counts == {"p": 5, "q": 1}


def test_word_list_and_text_sink(spark):
    d = tempfile.mkdtemp(prefix="cohortlab-words-")
    _write(os.path.join(d, "w.txt"), "would\nmay\nwould\n")
    assert sorted(r["word"] for r in read_word_list(spark, os.path.join(d, "w.txt")).collect()) == ["may", "would"]
    out = os.path.join(d, "out")
    write_text(spark.createDataFrame([("a",), ("b",)], "value string"), out, single=True)
    assert sorted(r["value"] for r in spark.read.text(out).collect()) == ["a", "b"]
    assert os.path.isfile(out)


def test_normalize_quoted_text(spark):
    df = spark.createDataFrame([(1, 'a ""q"" b,c\r\n   \nd    e\r\n\nlast\r')], "id int, t string")
    full = normalize_quoted_text(df, "t").first()["t"]
    assert full == "a q b;c d  e last\r"
    light = normalize_quoted_text_light(df, "t").first()["t"]
    assert light == 'a  q  b;c\r\n   \nd    e\r\n\nlast\r'
    kept = normalize_quoted_text(df, "t", join_lines=False).first()["t"]
    assert kept == "a q b;c\r\nd  e\r\nlast\r"


def test_flags_from_long_matches_wide_fixture(spark, sf_dir):
    from cohortlab.sources import fixtures as fx
    from cohortlab.sources.loaders import flags_from_long
    cols = [f"f{i}" for i in range(30)]
    a = load_flags(flags_from_long(fx.flags(spark, sf_dir)), pid="pid", hadm="hadm", flag_cols=cols)
    b = load_flags(fx.flags_wide(spark, sf_dir), pid="pid", hadm="hadm", flag_cols=cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_raw_csv_export_and_load(spark, sf_dir):
    from cohortlab.plans.catalog import Tables
    from cohortlab.sources.raw import export_raw_csv, load_raw_tables, raw_counts
    d = tempfile.mkdtemp(prefix="cohortlab-raw-")
    export_raw_csv(spark, sf_dir, d)
    raw = load_raw_tables(spark, d)
    t = Tables(spark, sf_dir)
    counts = {r["table"]: r["n"] for r in raw_counts(raw).collect()}
    assert counts == {"subjects": t.subjects().count(), "episodes": t.episodes().count(),
                      "scores": t.scores().count()}
    assert raw["notes"].count() == t.notes().count()
    a = raw["notes"].select(F.col("pid").cast("bigint"), F.col("ts"), F.length("text").alias("n"))
    b = t.notes(with_text=True).select("pid", "ts", F.length("text").alias("n"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    f1 = raw["flags"].select(F.col("pid").cast("bigint"), "flags")
    f2 = t.flags().select("pid", "flags")
    assert f1.exceptAll(f2).count() == 0


def _awk_notes(text):
    """The note filter, line by line."""
    import re
    out, buf = [], None
    for line in text.split("\n")[:-1] if text.endswith("\n") else text.split("\n"):
        line = line.replace('""', " ").replace("  ", " ")
        if re.fullmatch(r"[ \t\x0b\f\r]*", line):
            continue
        odd = line.count('"') % 2
        if buf is None and not odd:
            out.append(line)
        elif buf is not None and odd:
            out.append(" ".join([*buf, line]))
            buf = None
        else:
            buf = [*(buf or []), line[:-1] if line.endswith("\r") else line]
    return [_awk_commas(x) for x in out]


def _awk_commas(line):
    return '"'.join(x.replace(",", ";") if i % 2 else x for i, x in enumerate(line.split('"')))


def test_raw_notes_are_repaired_in_parallel(spark, tmp_path):
    import random
    from cohortlab.sources import repair
    rnd = random.Random(5)
    for n in range(2):
        text = "".join(rnd.choice(['"', '""', ",", "a", "b c", "  ", "    ", "\n", "\n", "\r\n", "\t", "é"]) for _ in range(4000))
        (tmp_path / f"f{n}.csv").write_bytes((text + "\n").encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert repair.read_lines(spark, str(tmp_path / "f0.csv")).rdd.getNumPartitions() > 8
        rows = repair.repaired_notes(spark, str(tmp_path)).collect()
        lab = repair.repaired_lab_lines(spark, str(tmp_path / "f0.csv")).orderBy("block", "at").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    for n in range(2):
        text = (tmp_path / f"f{n}.csv").read_bytes().decode()
        got = [r["value"] for r in sorted((r for r in rows if r["file"].endswith(f"f{n}.csv")), key=lambda r: r["record"])]
        assert got == _awk_notes(text) and len(got) > 50
    text = (tmp_path / "f0.csv").read_bytes().decode()
    assert [r["value"] for r in lab] == [_awk_commas(x.replace('""', " ")) for x in text.split("\n")[:-1]]


def test_doubled_quotes_of_a_raw_field(spark, tmp_path):
    from cohortlab.sources import repair
    (tmp_path / "n.csv").write_text('ID,TEXT,EMPTY\n1,"he said ""stop"" now, please\nnext",""\n2,plain,x\n3,"lost\n')
    df = repair.read_repaired_notes(spark, str(tmp_path / "n.csv"))
    assert sorted(map(tuple, df.collect())) == [("1", "he said stop now; please next", None), ("2", "plain", "x")]


def test_repair_shuffles_only_records_of_several_lines(spark, tmp_path):
    from cohortlab.sources import repair
    rows = [f'{i},"one line, {i}"' for i in range(300)] + [f'{i},"two\nlines, {i}"' for i in range(300, 330)]
    (tmp_path / "n.csv").write_text("\n".join(rows) + "\n")
    out = repair.repaired_notes(spark, str(tmp_path / "n.csv"))
    got = {r["record"]: r["value"] for r in out.collect()}
    assert got == {i + 1: (f'{i},"one line; {i}"' if i < 300 else f'{i},"two lines; {i}"') for i in range(330)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("collect_list") >= 1 and "ArrowEvalPython" not in plan      # the numbered lines are written


def test_single_file_sink(spark, tmp_path):
    import os

    from cohortlab.sources.csv_io import write_text
    target = f"{tmp_path}/deep/lines.txt"
    for n in (100, 7):                      # an old file is replaced
        df = spark.range(0, n, 1, 5).selectExpr("concat('line ', id) AS value")
        write_text(df, target, single=True)
        assert os.path.isfile(target) and os.listdir(f"{tmp_path}/deep") in (["lines.txt"], [".lines.txt.crc", "lines.txt"], ["lines.txt", ".lines.txt.crc"])
        with open(target) as f:
            assert f.read().splitlines() == [f"line {i}" for i in range(n)]
    write_text(spark.range(0).selectExpr("cast(id as string) AS value"), target, single=True)
    assert open(target).read() == ""


def test_bucketed_joins_shuffle_nothing(spark, sf_dir):
    from cohortlab.plans.catalog import Tables
    from cohortlab.sources import bucketed as B
    t = Tables(spark, sf_dir)
    names = B.save_bucketed({n: getattr(t, n)() for n in ("subjects", "episodes", "scores", "notes")}, buckets=6)
    s = B.load_bucketed(spark, names)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for df in (B.baseline_features_bucketed(s["subjects"], s["episodes"], s["scores"]),
                   B.notes_in_episode_bucketed(s["subjects"], s["episodes"], s["notes"])):
            assert df.count() > 0
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_flags_from_long_sends_one_row_an_admission(spark):
    from cohortlab.sources.loaders import flags_from_long
    long = spark.createDataFrame([(1, 10, i, None if i == 2 else i % 2) for i in range(4)] + [(1, 11, 9, 1), (2, 12, 0, 1)],
                                 "pid long, hadm long, flag_no int, flag int")
    wide = flags_from_long(long, n_flags=4)
    rows = {r["hadm"]: (r["pid"], r["f0"], r["f1"], r["f2"], r["f3"]) for r in wide.collect()}
    assert rows == {10: (1, 0, 1, None, 1), 11: (1, None, None, None, None), 12: (2, 1, None, None, None)}
    plan = wide._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate(") == 2 and "pivotfirst" not in plan.lower()      # partial and final


def test_compressed_export_holds_the_same_notes(spark, sf_dir):
    import glob
    import os
    from cohortlab.sources import raw
    from cohortlab.sources.csv_io import read_csv_table
    sizes, frames = [], []
    for codec, ending in (("none", "csv"), ("gzip", "csv.gz")):
        path = raw.export_raw_csv(spark, sf_dir, tempfile.mkdtemp(prefix="cohortlab-raw-"), only=("notes",), compression=codec)["notes"]
        files = glob.glob(f"{path}/part-*")
        assert files and all(f.endswith(ending) for f in files)
        sizes.append(sum(map(os.path.getsize, files)))
        frames.append(read_csv_table(spark, path, "NOTES", multi_line=True))
    a, b = frames
    assert a.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert sizes[1] * 2 < sizes[0]


def test_csv_files_hold_few_rows(spark):
    import glob
    from cohortlab.sources.csv_io import read_csv_table, write_csv_table
    path = tempfile.mkdtemp(prefix="cohortlab-csv-") + "/T.csv"
    write_csv_table(spark.range(25).coalesce(1), path, compression="gzip", rows_per_file=10)
    assert len(glob.glob(f"{path}/part-*.csv.gz")) == 3
    assert sorted(int(r["id"]) for r in read_csv_table(spark, path).collect()) == list(range(25))
