"""Query catalog: every operator bound to the driver's parquet tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and, where the result is
expressible in SQL, ``ORACLE[name]`` holds the DuckDB string that must give
the same rows. Outputs are normalised for comparison: timestamps as text,
integers as bigint, arrays as text or one row per element. Queries that fit a
model return what no solver decides (who is in, how many, which settings) and
whether the fitted numbers are in their range.

Every query reads whole tables; nothing is sampled, capped or filtered to
make the check cheaper. Model queries use few topics and iterations (``SMALL``),
on all subjects and at all hour marks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import operators as op
from ..constants import BASELINE_GRID, DERIVED_GRID, LDA_ITERATIONS, LDA_K, MIN_WORDS, SVM_ITERATIONS
from ..functions.hashing import hash_threshold
from ..functions.timecols import ts_text
from ..sources import fixtures as fx
from ..sources import loaders as ld
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Fixed query parameters (the library defaults stay as in the study).
SEED = 42
SPLIT, REBALANCE, FOLD = (f"{SEED}|{x}" for x in ("split", "rebalance", "fold"))   # as in operators.sampling
HOURS_PROBE = 2400          # episodes here last 200-599 days
SWEEP = (0, 4800, 240)      # hour sweep for this data
FIXED_WEIGHTS = (1.5, -0.4, 2.0)   # age, sex, score
FIXED_INTERCEPT = -1.0


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def normalise(df: DataFrame) -> DataFrame:
    """Timestamps -> text, small integers -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = ts_text(c)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Tables:
    """The study's inputs and shared steps for one (session, folder)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def subjects(self) -> DataFrame:
        return ld.load_subjects(fx.subject(self.spark, self.dir), pid="pid", gender="gender",
                                dob="dob", dod="dod", expire_flag="expire_flag")

    def episodes(self) -> DataFrame:
        return ld.load_episodes(fx.episode(self.spark, self.dir), pid="pid", hadm="hadm",
                                stay="stay", intime="in_ts", outtime="out_ts")

    def notes(self, with_text: bool = False) -> DataFrame:
        raw = fx.note(self.spark, self.dir, with_text=with_text)
        return ld.load_notes(raw, pid="pid", hadm="hadm", chartdate="chartdate",
                             charttime="charttime", storetime="storetime", category="category",
                             description=None, text="text" if with_text else None,
                             keep=("note_id", "doc_id"))

    def scores(self) -> DataFrame:
        return ld.load_scores(fx.score(self.spark, self.dir), pid="pid", hadm="hadm", stay="stay",
                              score_cols=["score"])

    def flags(self) -> DataFrame:
        wide = fx.flags_wide(self.spark, self.dir)
        return ld.load_flags(wide, pid="pid", hadm="hadm", flag_cols=[f"f{i}" for i in range(30)])

    def cohort(self) -> DataFrame:
        return op.build_cohort(self.subjects(), self.episodes())

    def notes_in_episode(self, cohort: DataFrame | None = None) -> DataFrame:
        """In-episode notes, texts attached only after the cohort join."""
        c = cohort if cohort is not None else self.cohort()
        inep = op.notes_in_episode(c, self.notes(with_text=False), carry=op.text.COHORT)
        return fx.attach_text(self.spark, self.dir, inep)

    def note_cohort(self, cohort: DataFrame | None = None) -> dict[str, DataFrame]:
        c = cohort if cohort is not None else self.cohort()
        return op.note_cohort(c, notes_in_ep=self.notes_in_episode(c))

    def labels(self, cohort: DataFrame | None = None, kind: str = "in_episode") -> DataFrame:
        return op.label_events(cohort if cohort is not None else self.cohort(), kind)

    def documents(self) -> DataFrame:
        """Documents, spread over the cores when the scan is a single split."""
        return fx.spread_scan(fx.table(self.spark, self.dir, "documents"))


# =================================================================== sources
@query("load_subjects", O.sql(
    f"SELECT pid, CAST(is_male AS BIGINT) AS is_male, {O.ts_text('dob')} AS dob, "
    f"CAST(is_dead AS BIGINT) AS is_dead, {O.ts_text('dod')} AS dod, "
    f"'1971-01-01 00:00:00' AS index_date, 0.0::DOUBLE AS age FROM subj", "subj"))
def q_load_subjects(spark, d):
    return normalise(Tables(spark, d).subjects())


@query("load_episodes", O.sql(
    f"SELECT pid, hadm, stay, {O.ts_text('in_ts')} AS in_ts, {O.ts_text('out_ts')} AS out_ts FROM ep", "ep"))
def q_load_episodes(spark, d):
    return normalise(Tables(spark, d).episodes())


@query("load_scores", O.sql("SELECT pid, hadm, stay, score FROM scr", "scr"))
def q_load_scores(spark, d):
    return normalise(Tables(spark, d).scores())


_REST = ld.SCORE_FIELDS[1:]


@query("load_scores_all", O.sql("SELECT pid, hadm, stay, score, " + ", ".join(
    f"CASE WHEN stay % {11 + i} = 0 THEN 0.0 ELSE CAST((stay * {7 + i}) % {20 + i} AS DOUBLE) END AS {c}"
    for i, c in enumerate(_REST)) + " FROM scr", "scr"))
def q_load_scores_all(spark, d):
    """All score fields of the export."""
    return normalise(ld.load_scores(fx.score_wide(spark, d), pid="pid", hadm="hadm", stay="stay"))


@query("load_flags", O.sql("SELECT pid, hadm, flag_str FROM flg", "flg"))
def q_load_flags(spark, d):
    f = Tables(spark, d).flags()
    return f.select("pid", "hadm", F.array_join(F.transform("flags", lambda x: x.cast("int").cast("string")),
                                                "").alias("flag_str"))


@query("load_flags_long", O.sql("SELECT pid, hadm, flag_str FROM flg", "flg"))
def q_load_flags_long(spark, d):
    """The long (one row per flag) layout pivoted to flag columns, then loaded."""
    wide = ld.flags_from_long(fx.flags(spark, d))
    f = ld.load_flags(wide, pid="pid", hadm="hadm", flag_cols=[f"f{i}" for i in range(30)])
    return f.select("pid", "hadm", F.array_join(F.transform("flags", lambda x: x.cast("int").cast("string")),
                                                "").alias("flag_str"))


@query("load_notes", O.sql(
    f"SELECT n.pid, n.hadm, {O.ts_text('n.ts')} AS ts, n.category, n.note_id, "
    "CAST(length(d.text) AS BIGINT) AS text_chars FROM notes n JOIN documents d ON n.doc_id = d.doc_id",
    "notes"))
def q_load_notes(spark, d):
    t = Tables(spark, d)
    n = fx.attach_text(spark, d, t.notes(with_text=False))
    return normalise(n.select("pid", "hadm", "ts", "category", "note_id",
                              F.length("text").cast("bigint").alias("text_chars")))


@query("table_counts", O.sql(
    "SELECT 'subjects' AS \"table\", count(*) AS n FROM subj UNION ALL "
    "SELECT 'episodes', count(*) FROM ep UNION ALL SELECT 'scores', count(*) FROM scr", "subj", "ep", "scr"))
def q_table_counts(spark, d):
    t = Tables(spark, d)
    return ld.table_counts({"subjects": t.subjects(), "episodes": t.episodes(), "scores": t.scores()})


# =================================================================== cohort
@query("join_subject_episode", O.sql(
    f"SELECT e.pid, e.stay, {O.ts_text('e.in_ts')} AS in_ts, {O.ts_text('s.dob')} AS dob, "
    "CAST(s.is_male AS BIGINT) AS is_male FROM ep e JOIN subj s ON e.pid = s.pid", "ep", "subj"))
def q_join_subject_episode(spark, d):
    t = Tables(spark, d)
    j = op.join_subject_episode(t.subjects(), t.episodes())
    return normalise(j.select("pid", "stay", "in_ts", "dob", "is_male"))


@query("latest_episode", O.sql(
    f"SELECT pid, hadm, stay, {O.ts_text('in_ts')} AS in_ts, {O.ts_text('out_ts')} AS out_ts FROM latest",
    "latest"))
def q_latest_episode(spark, d):
    return normalise(op.latest_episode(Tables(spark, d).episodes()))


@query("cohort_latest_episode", O.sql(
    f"SELECT pid, hadm, stay, {O.ts_text('in_ts')} AS in_ts, {O.ts_text('out_ts')} AS out_ts, "
    f"CAST(is_male AS BIGINT) AS is_male, {O.ts_text('dod')} AS dod, age FROM cohort", "cohort"))
def q_cohort(spark, d):
    c = Tables(spark, d).cohort()
    return normalise(c.select("pid", "hadm", "stay", "in_ts", "out_ts", "is_male", "dod", "age"))


def _label_query(kind: str):
    def fn(spark, d):
        return normalise(Tables(spark, d).labels(kind=kind))
    return fn


for _kind, _name in (("in_episode", "labels_in_episode"), ("30d", "labels_30d"), ("1y", "labels_1y")):
    query(_name, O.sql(f"SELECT pid, CAST(label_{_kind} AS BIGINT) AS label FROM labels", "labels"))(
        _label_query(_kind))


@query("notes_in_episode", O.sql(
    f"SELECT pid, hadm, {O.ts_text('ts')} AS ts, note_id, doc_id FROM inep", "inep"))
def q_notes_in_episode(spark, d):
    t = Tables(spark, d)
    inep = op.notes_in_episode(t.cohort(), t.notes(with_text=False))
    return normalise(inep.select("pid", "hadm", "ts", "note_id", "doc_id"))


@query("words_per_subject", O.sql("SELECT pid, n_words FROM words", "words"))
def q_words_per_subject(spark, d):
    t = Tables(spark, d)
    return op.words_per_subject(op.tokenize(t.notes_in_episode()))


@query("min_word_subjects", O.sql("SELECT pid, n_words FROM kept_words", "kept_words"))
def q_min_word_subjects(spark, d):
    t = Tables(spark, d)
    return op.min_word_subjects(op.tokenize(t.notes_in_episode()), MIN_WORDS)


@query("first_event", O.sql(f"SELECT pid, {O.ts_text('first_ts')} AS first_ts FROM first", "first"))
def q_first_event(spark, d):
    return normalise(op.first_event(Tables(spark, d).note_cohort()["notes"]))


@query("note_cohort", O.sql(
    f"SELECT c.pid, c.stay, {O.ts_text('f.first_ts')} AS first_ts, k.n_words, "
    "(SELECT count(*) FROM kept_notes n WHERE n.pid = c.pid) AS n_notes "
    "FROM cohort c JOIN first f ON c.pid = f.pid JOIN kept_words k ON c.pid = k.pid",
    "cohort", "first", "kept_words", "kept_notes"))
def q_note_cohort(spark, d):
    out = Tables(spark, d).note_cohort()["wide"]
    return normalise(out.select("pid", "stay", "n_words", "first_ts", "n_notes"))


@query("with_first_event", O.sql(
    f"SELECT c.pid, c.stay, {O.ts_text('f.first_ts')} AS first_ts FROM cohort c JOIN first f ON c.pid = f.pid",
    "cohort", "first"))
def q_with_first_event(spark, d):
    t = Tables(spark, d)
    c = t.cohort()
    first = t.note_cohort(c)["first"]
    return normalise(op.with_first_event(c, first).select("pid", "stay", "first_ts"))


def _present_query(hours: int):
    def fn(spark, d):
        t = Tables(spark, d)
        c = t.cohort()
        first = t.note_cohort(c)["first"]
        return normalise(op.present_after_hours(c, first, hours).select("pid", "stay"))
    return fn


for _h, _name in ((HOURS_PROBE, "present_after_hours"), (0, "present_after_hours_0")):
    O.present_cte(_h, f"present_{_h}")
    query(_name, O.sql(f"SELECT pid, stay FROM present_{_h}", f"present_{_h}"))(_present_query(_h))


@query("notes_within_hours", O.sql(
    f"SELECT n.pid, n.note_id, {O.ts_text('n.ts')} AS ts FROM kept_notes n JOIN first f ON n.pid = f.pid "
    f"WHERE epoch_ms(n.ts) < epoch_ms(f.first_ts) + {HOURS_PROBE * 3600000}", "kept_notes", "first"))
def q_notes_within_hours(spark, d):
    nc = Tables(spark, d).note_cohort()
    out = op.events_within_hours(nc["notes"], nc["first"], HOURS_PROBE)
    return normalise(out.select("pid", "note_id", "ts"))


@query("notes_within_hours_surviving", O.sql(
    f"SELECT n.pid, n.note_id, {O.ts_text('n.ts')} AS ts FROM kept_notes n JOIN first f ON n.pid = f.pid "
    f"WHERE epoch_ms(n.ts) < epoch_ms(f.first_ts) + {HOURS_PROBE * 3600000} "
    f"AND n.pid IN (SELECT pid FROM present_{HOURS_PROBE})", "kept_notes", "first", f"present_{HOURS_PROBE}"))
def q_notes_within_hours_surviving(spark, d):
    t = Tables(spark, d)
    c = t.cohort()
    nc = t.note_cohort(c)
    surv = op.present_after_hours(c, nc["first"], HOURS_PROBE)
    out = op.events_within_hours(nc["notes"], nc["first"], HOURS_PROBE, survivors=surv)
    return normalise(out.select("pid", "note_id", "ts"))


@query("tokens_within_hours", O.sql(
    f"SELECT t.pid, t.note_id, array_to_string(t.tokens, ' ') AS tokens FROM tok t JOIN first f ON t.pid = f.pid "
    f"WHERE epoch_ms(t.ts) < epoch_ms(f.first_ts) + {HOURS_PROBE * 3600000}", "tok", "first"))
def q_tokens_within_hours(spark, d):
    nc = Tables(spark, d).note_cohort()
    out = op.events_within_hours(nc["tokens"], nc["first"], HOURS_PROBE)
    return out.select("pid", "note_id", F.array_join("tokens", " ").alias("tokens"))


@query("cohort_labels", O.sql(
    "SELECT c.pid, c.stay, CAST(c.is_male AS BIGINT) AS is_male, c.age, "
    "CAST(l.label_in_episode AS BIGINT) AS label_in_episode, CAST(l.label_30d AS BIGINT) AS label_30d, "
    "CAST(l.label_1y AS BIGINT) AS label_1y FROM cohort c JOIN labels l ON c.pid = l.pid", "cohort", "labels"))
def q_cohort_labels(spark, d):
    c = Tables(spark, d).cohort()
    labels = [op.cohort.label_expr(k).alias(f"label_{k}") for k in op.cohort.LABEL_KINDS]
    return normalise(c.select("pid", "stay", "is_male", "age", *labels))


# =================================================================== text
@query("clean_text", O.sql(f"SELECT doc_id, {O.clean_sql('text')} AS text FROM documents"))
def q_clean_text(spark, d):
    from ..functions.textcols import clean_text
    return Tables(spark, d).documents().select("doc_id", clean_text("text").alias("text"))


O.cte("doc_tok", f"SELECT doc_id, {O.tokens_sql('text')} AS tokens FROM documents")


def _doc_tokens(spark, d) -> DataFrame:
    return op.tokenize(Tables(spark, d).documents().select("doc_id", "text"))


@query("tokenize", O.sql(
    "SELECT doc_id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS BIGINT) AS n_tokens "
    "FROM doc_tok", "doc_tok"))
def q_tokenize(spark, d):
    t = _doc_tokens(spark, d)
    return t.select("doc_id", F.array_join("tokens", " ").alias("tokens"),
                    F.size("tokens").cast("bigint").alias("n_tokens"))


@query("vocabulary", O.sql(
    "SELECT term, count(*) AS n FROM (SELECT unnest(tokens) AS term FROM doc_tok) GROUP BY term", "doc_tok"))
def q_vocabulary(spark, d):
    return op.vocabulary(_doc_tokens(spark, d))


@query("term_counts", O.sql(
    "SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM doc_tok) "
    "GROUP BY doc_id, term", "doc_tok"))
def q_term_counts(spark, d):
    return op.term_counts(_doc_tokens(spark, d), doc="doc_id")


@query("doc_index", O.sql(
    "SELECT pid, note_id, row_number() OVER (ORDER BY pid, ts, note_id) - 1 AS idx FROM inep", "inep"))
def q_doc_index(spark, d):
    t = Tables(spark, d)
    inep = op.notes_in_episode(t.cohort(), t.notes(with_text=False)).select("pid", "ts", "note_id")
    return op.dense_index(inep, ["pid", "ts", "note_id"]).select("pid", "note_id", "idx")


_NORM_FULL = ("regexp_replace(array_to_string(list_filter(string_split(replace(replace(text, '\"\"', ' '), "
              "'  ', ' '), chr(10)), lambda l: NOT regexp_full_match(l, '[ \\t\\r\\f\\x0B]*')), chr(10)), "
              "'\\r?\\n', ' ', 'g')")


@query("normalize_quoted_text", O.sql(f"SELECT doc_id, replace({_NORM_FULL}, ',', ';') AS text FROM documents"))
def q_normalize_quoted_text(spark, d):
    from ..sources.normalize import normalize_quoted_text
    return normalize_quoted_text(Tables(spark, d).documents().select("doc_id", "text"), "text")


@query("normalize_quoted_text_light", O.sql(
    "SELECT doc_id, replace(replace(text, '\"\"', ' '), ',', ';') AS text FROM documents"))
def q_normalize_quoted_text_light(spark, d):
    from ..sources.normalize import normalize_quoted_text_light
    return normalize_quoted_text_light(Tables(spark, d).documents().select("doc_id", "text"), "text")


@query("csv_roundtrip", ORACLE["load_subjects"])
def q_csv_roundtrip(spark, d):
    """Subjects written as a raw CSV export (text columns, header) to the
    shared scratch folder, read back with the CSV source and loaded."""
    from ..session import scratch_path
    from ..sources.csv_io import read_csv_table, write_csv_table
    s = fx.subject(spark, d)
    raw = s.select(F.col("pid").cast("string").alias("SUBJECT_ID"), F.col("gender").alias("GENDER"),
                   ts_text("dob").alias("DOB"), F.coalesce(ts_text("dod"), F.lit("")).alias("DOD"),
                   F.col("expire_flag").cast("string").alias("EXPIRE_FLAG"))
    path = scratch_path(spark, "csv_roundtrip")
    write_csv_table(raw, path)
    back = read_csv_table(spark, path, "PATIENTS")
    subj = ld.load_subjects(back)
    return normalise(subj.withColumn("pid", F.col("pid").cast("bigint")))


@query("csv_roundtrip_notes", O.sql(
    f"SELECT n.pid, n.hadm, {O.ts_text('n.ts')} AS ts, n.category, "
    "CAST(length(d.text) AS BIGINT) AS text_chars FROM notes n JOIN documents d ON n.doc_id = d.doc_id",
    "notes"))
def q_csv_roundtrip_notes(spark, d):
    """All notes written as the raw export (quoted texts that span lines,
    compressed files) to the shared scratch folder, read back with the multi-line
    CSV reader and loaded by the notes loader."""
    from ..session import scratch_path
    from ..sources.csv_io import read_csv_table
    from ..sources.raw import export_raw_csv
    folder = scratch_path(spark, "csv_roundtrip_notes")
    export_raw_csv(spark, d, folder, only=("notes",), compression="gzip")
    raw = read_csv_table(spark, f"{folder}/NOTEEVENTS.csv", multi_line=True)
    n = ld.load_notes(raw)
    return normalise(n.select(F.col("pid").cast("bigint").alias("pid"), F.col("hadm").cast("bigint").alias("hadm"),
                              "ts", "category", F.length("text").cast("bigint").alias("text_chars")))


@query("csv_table_name", O.sql(
    "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation"))
def q_csv_table_name(spark, d):
    """A CSV read without a name: the view is called after the path."""
    from ..session import scratch_path
    from ..sources.csv_io import read_csv_table, write_csv_table
    path = scratch_path(spark, "csv_table_name") + "/NATIONS.csv"
    write_csv_table(fx.table(spark, d, "nation").select("n_nationkey", "n_name"), path)
    read_csv_table(spark, path)
    return spark.table("NATIONS").select("n_nationkey", "n_name")


@query("tokenize_word_file", O.sql(
    "SELECT doc_id, array_to_string(list_filter(tokens, lambda t: length(t) > 5), ' ') AS tokens FROM ("
    f"SELECT doc_id, {O.tokens_sql('text', stop=False)} AS tokens FROM documents)"))
def q_tokenize_word_file(spark, d):
    """Stop words from a file of words (here all terms of up to five
    letters, one per line), applied by a join."""
    from ..session import scratch_path
    from ..sources.csv_io import read_word_list, write_text
    docs = Tables(spark, d).documents().select("doc_id", "text")
    path = scratch_path(spark, "stop_words")
    write_text(op.vocabulary(op.tokenize(docs, stopwords=[])).select("term").filter(F.length("term") <= 5), path)
    t = op.tokenize(docs, stopwords=read_word_list(spark, path))
    return t.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query("text_sink_roundtrip", O.sql(
    "SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || c_mktsegment AS value FROM customer"))
def q_text_sink_roundtrip(spark, d):
    from ..session import scratch_path
    from ..sources.csv_io import write_text
    c = fx.table(spark, d, "customer")
    path = scratch_path(spark, "text_sink")
    write_text(c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
                        .alias("value")), path)
    return spark.read.text(path)


@query("text_sink_single", ORACLE["text_sink_roundtrip"])
def q_text_sink_single(spark, d):
    """Written by all tasks, merged to one file."""
    from ..session import scratch_path
    from ..sources.csv_io import write_text
    c = fx.table(spark, d, "customer")
    path = scratch_path(spark, "text_sink_single") + "/lines.txt"
    write_text(c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
               .repartition(7), path, single=True)
    return spark.read.text(path)


def _raw_export(spark, d) -> str:
    """A raw export of the documents: quoted fields, doubled quotes, texts that
    span lines. Every fourth document stands without quotes around its id."""
    from ..session import scratch_path
    path = scratch_path(spark, "raw_export")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    key = F.when(F.col("doc_id") % 4 == 0, F.col("doc_id").cast("string")).otherwise(F.concat(F.lit('"'), F.col("doc_id"), F.lit('"')))
    Tables(spark, d).documents().select(F.concat(key, F.lit(",nurse, ward,"), quoted).alias("value")).write.text(path)
    return path


_RAW = ("SELECT CASE WHEN doc_id % 4 = 0 THEN CAST(doc_id AS VARCHAR) ELSE '\"' || doc_id || '\"' END || ',nurse, ward,\"' "
        "|| replace(text, '\"', '\"\"') || '\"' AS r FROM documents")
_COMMAS = ("array_to_string(list_transform(string_split({x}, '\"'), lambda p, i: CASE WHEN i % 2 = 0 THEN replace(p, ',', ';') ELSE p END), '\"')")


@query("repaired_notes", f"""WITH raw AS ({_RAW}),
line AS (SELECT list_filter(string_split(replace(replace(r, '""', ' '), '  ', ' '), chr(10)),
                            lambda l: NOT regexp_full_match(l, '[ \\t\\r\\f\\x0B]*')) AS l FROM raw),
rec AS (SELECT array_to_string(list_transform(l, lambda x, i: CASE WHEN i < len(l) THEN regexp_replace(x, '\\r$', '') ELSE x END), ' ') AS v
        FROM line)
SELECT {_COMMAS.format(x='v')} AS value FROM rec""")
def q_repaired_notes(spark, d):
    """The repair of a raw note export (SRC-10), from the file itself."""
    from ..sources.repair import repaired_notes
    return repaired_notes(spark, _raw_export(spark, d)).select("value")


@query("repaired_lab_lines", f"""WITH raw AS ({_RAW}),
line AS (SELECT unnest(string_split(r, chr(10))) AS l FROM raw)
SELECT {_COMMAS.format(x="replace(l, '\"\"', ' ')")} AS value FROM line""")
def q_repaired_lab_lines(spark, d):
    """The repair of a raw lab export (SRC-11), line by line."""
    from ..sources.repair import repaired_lab_lines
    return repaired_lab_lines(spark, _raw_export(spark, d)).select("value")


@query("tokenize_large_word_file", ORACLE["tokenize_word_file"])
def q_tokenize_large_word_file(spark, d):
    """As ``tokenize_word_file``, without a list on the driver: what a list
    of more words than a task may look up takes. Texts are tokenized once."""
    from ..session import materialize
    docs = Tables(spark, d).documents().select("doc_id", "text")
    tok = materialize(op.tokenize(docs, stopwords=[]))
    stop = op.vocabulary(tok).select("term").filter(F.length("term") <= 5)
    t = op.text._without_words(tok, "tokens", "kept", stop)
    return t.select("doc_id", F.array_join("kept", " ").alias("tokens"))


# =================================================================== features
_BL = ("SELECT c.pid, c.age / CAST(89.0 AS DOUBLE) AS a, CAST(c.is_male AS DOUBLE) AS s, "
       "sc.score / CAST(163.0 AS DOUBLE) AS sc FROM {src} c JOIN scr sc "
       "ON c.pid = sc.pid AND c.hadm = sc.hadm AND c.stay = sc.stay")
O.cte("bl", _BL.format(src="cohort"), "cohort", "scr")
O.cte(f"bl_{HOURS_PROBE}", _BL.format(src=f"present_{HOURS_PROBE}"), f"present_{HOURS_PROBE}", "scr")
_LONG = ("SELECT pid, 'patient_age' AS feature, a AS value FROM {t} UNION ALL "
         "SELECT pid, 'patient_sex', s FROM {t} UNION ALL SELECT pid, 'saps_score', sc FROM {t}")
_WIDE = ("SELECT pid, CAST(0 AS BIGINT) AS idx, a AS value FROM {t} UNION ALL "
         "SELECT pid, 1, s FROM {t} UNION ALL SELECT pid, 2, sc FROM {t}")


@query("baseline_features_long", O.sql(_LONG.format(t="bl"), "bl"))
def q_baseline_features_long(spark, d):
    t = Tables(spark, d)
    return op.baseline_features_long(t.cohort(), t.scores())


@query("baseline_features_at_hours", O.sql(_LONG.format(t=f"bl_{HOURS_PROBE}"), f"bl_{HOURS_PROBE}"))
def q_baseline_features_at_hours(spark, d):
    t = Tables(spark, d)
    c = t.cohort()
    return op.baseline_features_long(c, t.scores(), t.note_cohort(c)["first"], HOURS_PROBE)


@query("baseline_features_wide", O.sql(_WIDE.format(t="bl"), "bl"))
def q_baseline_features_wide(spark, d):
    t = Tables(spark, d)
    return normalise(op.array_to_long(op.baseline_features_wide(t.cohort(), t.scores()), ["pid"], "features"))


@query("baseline_wide_at_hours", O.sql(_WIDE.format(t=f"bl_{HOURS_PROBE}"), f"bl_{HOURS_PROBE}"))
def q_baseline_wide_at_hours(spark, d):
    t = Tables(spark, d)
    c = t.cohort()
    w = op.baseline_features_wide(c, t.scores(), t.note_cohort(c)["first"], HOURS_PROBE)
    return normalise(op.array_to_long(w, ["pid"], "features"))


def _bucketed(spark, d, *names: str) -> dict[str, DataFrame]:
    from ..sources.bucketed import load_bucketed, save_bucketed
    t = Tables(spark, d)
    return load_bucketed(spark, save_bucketed({n: getattr(t, n)() for n in names}))


@query("baseline_features_bucketed", ORACLE["baseline_features_wide"])
def q_baseline_features_bucketed(spark, d):
    """The joins of the study over tables stored by subject."""
    from ..sources.bucketed import baseline_features_bucketed
    t = _bucketed(spark, d, "subjects", "episodes", "scores")
    return normalise(op.array_to_long(baseline_features_bucketed(t["subjects"], t["episodes"], t["scores"]), ["pid"], "features"))


@query("notes_in_episode_bucketed", ORACLE["notes_in_episode"])
def q_notes_in_episode_bucketed(spark, d):
    from ..sources.bucketed import notes_in_episode_bucketed
    t = _bucketed(spark, d, "subjects", "episodes", "notes")
    return normalise(notes_in_episode_bucketed(t["subjects"], t["episodes"], t["notes"]).select("pid", "hadm", "ts", "note_id", "doc_id"))


@query("notes_in_episode_binned", ORACLE["notes_in_episode"])
def q_notes_in_episode_binned(spark, d):
    """Admissions of three notes or more are dealt by time bins of 30 days."""
    t = Tables(spark, d)
    return normalise(op.notes_in_episode_binned(t.cohort(), t.notes(), bin_hours=720, hot_rows=2).select("pid", "hadm", "ts", "note_id", "doc_id"))


O.cte("fv", "SELECT f.pid, f.flag_str, f.flags FROM flg f JOIN cohort c ON f.pid = c.pid AND f.hadm = c.hadm",
      "flg", "cohort")


@query("flag_vector", O.sql("SELECT pid, flag_str FROM fv", "fv"))
def q_flag_vector(spark, d):
    t = Tables(spark, d)
    fv = op.flag_vector(t.flags(), t.cohort())
    return fv.select("pid", F.array_join(F.transform("features", lambda x: x.cast("int").cast("string")),
                                         "").alias("flag_str"))


O.cte("derived", "SELECT pid, idx, value FROM (" + _WIDE.format(t="bl") + ") b "
      "WHERE pid IN (SELECT pid FROM fv) UNION ALL "
      "SELECT pid, CAST(i + 2 AS BIGINT) AS idx, flags[i] AS value FROM fv, range(1, 31) r(i) "
      "WHERE pid IN (SELECT pid FROM bl)", "bl", "fv")


def _derived(t: Tables) -> DataFrame:
    c = t.cohort()
    return op.derived_features(c, t.scores(), t.flags())


@query("derived_features", O.sql("SELECT pid, idx, value FROM derived", "derived"))
def q_derived_features(spark, d):
    return normalise(op.array_to_long(_derived(Tables(spark, d)), ["pid"], "features"))


@query("labeled_points_dense", O.sql(
    "SELECT x.pid, CAST(l.label_in_episode AS DOUBLE) AS label, x.idx, x.value "
    "FROM derived x JOIN labels l ON x.pid = l.pid", "derived", "labels"))
def q_labeled_points_dense(spark, d):
    from pyspark.ml.functions import vector_to_array
    t = Tables(spark, d)
    pts = op.labeled_points_dense(_derived(t), t.labels())
    return normalise(op.array_to_long(pts.select("pid", "label", vector_to_array("features").alias("f")),
                                      ["pid", "label"], "f"))


O.cte("fdict", "SELECT name, CAST(row_number() OVER (ORDER BY name) - 1 AS BIGINT) AS \"index\" FROM "
      "(SELECT DISTINCT lower(feature) AS name FROM (" + _LONG.format(t="bl") + "))", "bl")


@query("feature_dictionary", O.sql("SELECT name, \"index\" FROM fdict", "fdict"))
def q_feature_dictionary(spark, d):
    t = Tables(spark, d)
    fd = op.feature_dictionary(op.baseline_features_long(t.cohort(), t.scores()))
    return fd.select("name", F.col("index").cast("bigint"))


@query("labeled_points_sparse", O.sql(
    "SELECT x.pid, CAST(l.label_in_episode AS DOUBLE) AS label, (SELECT CAST(count(*) AS BIGINT) FROM fdict) "
    "AS size, fd.\"index\", x.value FROM (" + _LONG.format(t="bl") + ") x JOIN fdict fd ON lower(x.feature) = "
    "fd.name JOIN labels l ON x.pid = l.pid", "bl", "fdict", "labels"))
def q_labeled_points_sparse(spark, d):
    t = Tables(spark, d)
    pts = op.labeled_points_sparse(op.baseline_features_long(t.cohort(), t.scores()), t.labels())
    z = pts.select("pid", "label", F.col("size").cast("bigint").alias("size"),
                   F.explode(F.arrays_zip("indices", "values")).alias("z"))
    return z.select("pid", "label", "size", F.col("z.indices").cast("bigint").alias("index"),
                    F.col("z.values").alias("value"))


@query("mean_vector_by_key", O.sql(
    "SELECT CAST(label AS BIGINT) AS label, CAST(i - 1 AS BIGINT) AS idx, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean "
    "FROM embeddings, range(1, 1 + (SELECT max(len(embedding)) FROM embeddings)) r(i) "
    "WHERE i <= len(embedding) GROUP BY label, i"))
def q_mean_vector_by_key(spark, d):
    e = fx.table(spark, d, "embeddings")
    m = op.mean_vector_by_key(e, "label", "embedding")
    out = op.array_to_long(m, ["label"], "mean", value="mean")
    return normalise(out.select("label", "idx", F.round("mean", 6).alias("mean")))


# =================================================================== metrics
# Scores and labels for metric checks: lineitem discount as the score, a
# returned item as the positive class (few distinct scores, many ties).
def _scored_items(spark, d) -> DataFrame:
    li = fx.table(spark, d, "lineitem")
    return li.select(F.col("l_discount").alias("score"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))


O.cte("items", "SELECT l_discount AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem")
THRESHOLD = 0.05


def auc_sql(src: str, by: str | None = None) -> str:
    """Exact AUC with tied scores (same arithmetic as ``auc_by_rank``)."""
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return (f"SELECT {g}CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL ELSE "
            f"sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + neg / 2.0)) / "
            f"CAST(sum(pos) * sum(neg) AS DOUBLE) END AS auc, "
            f"CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM ("
            f"SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING), 0) AS below FROM ("
            f"SELECT {g}score, sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS pos, "
            f"sum(CASE WHEN label > 0 THEN 0 ELSE 1 END) AS neg FROM {src} WHERE score IS NOT NULL "
            f"GROUP BY {g}score)) {grp}")


def confusion_sql(src: str, threshold: float, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    pred = f"(CASE WHEN score > {threshold!r} THEN 1.0 ELSE 0.0 END)"
    lab = "CAST(label AS DOUBLE)"
    cnt = "CAST(coalesce(sum(CASE WHEN {} THEN 1 ELSE 0 END), 0) AS BIGINT)".format
    return (f"SELECT {g}{cnt(f'{pred} = {lab} AND {lab} > 0')} AS tp, "
            f"{cnt(f'{pred} <> {lab} AND NOT {lab} > 0')} AS fp, "
            f"{cnt(f'{pred} = {lab} AND NOT {lab} > 0')} AS tn, "
            f"{cnt(f'{pred} <> {lab} AND {lab} > 0')} AS fn FROM {src} WHERE score IS NOT NULL {grp}")


def metrics_sql(src: str, threshold: float) -> str:
    def div(a, b):
        return f"CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"
    return (f"SELECT tp + fp + tn + fn AS total, tp + fn AS positives, a.auc, "
            f"{div('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {div('tp', 'tp + fn')} AS sensitivity, "
            f"{div('tn', 'fp + tn')} AS specificity FROM ({confusion_sql(src, threshold)}) c, "
            f"({auc_sql(src)}) a")


@query("confusion_counts", O.sql(confusion_sql("items", THRESHOLD), "items"))
def q_confusion_counts(spark, d):
    return op.confusion_counts(_scored_items(spark, d), threshold=THRESHOLD)


@query("auc_by_rank", O.sql(auc_sql("items"), "items"))
def q_auc_by_rank(spark, d):
    return op.auc_by_rank(_scored_items(spark, d))


@query("binary_metrics", O.sql(metrics_sql("items", THRESHOLD), "items"))
def q_binary_metrics(spark, d):
    return op.binary_metrics(_scored_items(spark, d), threshold=THRESHOLD)


@query("label_balance", O.sql(
    "SELECT count(*) AS n, CAST(coalesce(sum(label_in_episode), 0) AS BIGINT) AS positives FROM labels",
    "labels"))
def q_label_balance(spark, d):
    return op.label_balance(Tables(spark, d).labels())


@query("stage_counts", O.sql(
    "SELECT 'subjects' AS stage, count(*) AS n FROM subj UNION ALL SELECT 'episodes', count(*) FROM ep "
    "UNION ALL SELECT 'cohort', count(*) FROM cohort UNION ALL SELECT 'notes', count(*) FROM notes "
    "UNION ALL SELECT 'notes_in_episode', count(*) FROM inep UNION ALL "
    "SELECT 'note_subjects', count(*) FROM first UNION ALL SELECT 'kept_notes', count(*) FROM kept_notes "
    "UNION ALL SELECT 'positives_in_episode', CAST(sum(label_in_episode) AS BIGINT) FROM labels",
    "subj", "ep", "cohort", "notes", "inep", "first", "kept_notes", "labels"))
def q_stage_counts(spark, d):
    t = Tables(spark, d)
    c = t.cohort()
    nc = t.note_cohort(c)
    counts = op.stage_counts({
        "subjects": t.subjects(), "episodes": t.episodes(), "cohort": c, "notes": t.notes(),
        "notes_in_episode": op.notes_in_episode(c, t.notes()), "note_subjects": nc["first"],
        "kept_notes": nc["notes"]})
    pos = op.label_balance(t.labels(c)).select(F.lit("positives_in_episode").alias("stage"),
                                               F.col("positives").alias("n"))
    return counts.unionByName(pos)


def _linear(x: str) -> str:
    w0, w1, w2 = FIXED_WEIGHTS
    return (f"(((0.0::DOUBLE + {x}.a * CAST({w0!r} AS DOUBLE)) + {x}.s * CAST({w1!r} AS DOUBLE)) "
            f"+ {x}.sc * CAST({w2!r} AS DOUBLE)) + CAST({FIXED_INTERCEPT!r} AS DOUBLE)")


O.cte("train_subjects", f"SELECT pid FROM cohort WHERE {O.unit_hash_sql('pid', SPLIT)} < {hash_threshold(0.7)}",
      "cohort")


@query("restrict_to_split", O.sql(
    "SELECT x.pid, x.feature, x.value FROM (" + _LONG.format(t="bl") + ") x "
    "WHERE x.pid IN (SELECT pid FROM train_subjects)", "bl", "train_subjects"))
def q_restrict_to_split(spark, d):
    t = Tables(spark, d)
    c = t.cohort()
    train, _ = op.split_hash(c.select("pid"), 0.7, SEED)
    return op.restrict_to_subjects(op.baseline_features_long(c, t.scores()), train)


@query("linear_score", O.sql(f"SELECT b.pid, {_linear('b')} AS score FROM bl b", "bl"))
def q_linear_score(spark, d):
    from .models import linear_score
    t = Tables(spark, d)
    w = op.baseline_features_wide(t.cohort(), t.scores())
    return linear_score(w, list(FIXED_WEIGHTS), FIXED_INTERCEPT).select("pid", "score")


O.cte("test_subjects", f"SELECT pid FROM cohort WHERE {O.unit_hash_sql('pid', SPLIT)} >= "
      f"{hash_threshold(0.7)}", "cohort")
O.cte("sweep", f"""SELECT h.hour, b.pid, {_linear('b')} AS score, l.label_in_episode AS label
FROM bl b JOIN labels l ON b.pid = l.pid JOIN test_subjects t ON b.pid = t.pid
JOIN cohort c ON b.pid = c.pid LEFT JOIN first f ON b.pid = f.pid,
range({SWEEP[0]}, {SWEEP[1] + 1}, {SWEEP[2]}) h(hour)
WHERE h.hour <= 0 OR (f.first_ts IS NOT NULL
  AND epoch_ms(c.out_ts) > epoch_ms(f.first_ts) + h.hour * 3600000
  AND epoch_ms(c.dod) > epoch_ms(f.first_ts) + h.hour * 3600000)""",
      "bl", "labels", "test_subjects", "cohort", "first")


@query("hourly_auc_baseline", O.sql(
    "SELECT a.hour, t.total, t.positives, a.auc FROM (" + auc_sql("sweep", "hour") + ") a JOIN "
    "(SELECT hour, count(*) AS total, CAST(sum(label) AS BIGINT) AS positives FROM sweep GROUP BY hour) t "
    "ON a.hour = t.hour", "sweep"))
def q_hourly_auc_baseline(spark, d):
    from ..session import materialize
    from .models import linear_score
    from .study import hourly_auc
    t = Tables(spark, d)
    c = materialize(t.cohort())  # one wide row per subject, read by the scores and by the notes
    wide = op.baseline_features_wide(c, t.scores(), keep=("in_ts", "out_ts", "dod"))
    _, test = op.split_hash(wide, 0.7, SEED)
    scored = linear_score(test, list(FIXED_WEIGHTS), FIXED_INTERCEPT).withColumn("label", op.cohort.label_expr("in_episode"))
    res = hourly_auc(scored, None, t.note_cohort(c)["first"], hours=range(SWEEP[0], SWEEP[1] + 1, SWEEP[2]))
    return res.select(F.col("hour").cast("bigint"), "total", "positives", "auc")


# =================================================================== sampling
def _split_sql(m_expr: str, seed: str) -> str:
    return (f"SELECT pid, CASE WHEN rn <= ({m_expr}) THEN 'train' ELSE 'test' END AS part FROM ("
            f"SELECT pid, row_number() OVER (ORDER BY {O.unit_hash_sql('pid', seed)}, pid) AS rn FROM cohort)")


@query("split_exact", O.sql(_split_sql(
    "SELECT CAST(floor(count(*) * CAST(0.7 AS DOUBLE)) AS BIGINT) FROM cohort", SPLIT), "cohort"))
def q_split_exact(spark, d):
    c = Tables(spark, d).cohort().select("pid")
    tr, te = op.split_exact(c, 0.7, SEED)
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))


@query("split_hash", O.sql(
    f"SELECT pid, CASE WHEN {O.unit_hash_sql('pid', SPLIT)} < "
    f"{hash_threshold(0.7)} "
    "THEN 'train' ELSE 'test' END AS part FROM cohort", "cohort"))
def q_split_hash(spark, d):
    c = Tables(spark, d).cohort().select("pid")
    tr, te = op.split_hash(c, 0.7, SEED)
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))


O.cte("bal", """SELECT count(*) AS n, sum(label_in_episode) AS pos,
  CAST(sum(label_in_episode) AS DOUBLE) / CAST(0.3 AS DOUBLE) * CAST(0.7 AS DOUBLE) AS wanted FROM labels""",
      "labels")


@query("rebalance_negatives", O.sql(
    f"""SELECT pid, label FROM (
  SELECT l.pid, CAST(l.label_in_episode AS BIGINT) AS label,
    row_number() OVER (PARTITION BY l.label_in_episode ORDER BY {O.unit_hash_sql('l.pid', REBALANCE)}, l.pid) AS rn
  FROM labels l) x, bal
WHERE CAST(bal.pos AS DOUBLE) / CAST(bal.n AS DOUBLE) >= 0.3 OR x.label = 1 OR x.rn <= CAST(floor(bal.wanted) AS BIGINT)""",
    "labels", "bal"))
def q_rebalance_negatives(spark, d):
    lab = Tables(spark, d).labels()
    return normalise(op.rebalance_negatives(lab, "label", exact=True, seed=SEED))


@query("rebalance_negatives_hash", O.sql(
    f"""SELECT pid, label FROM (
  SELECT l.pid, CAST(l.label_in_episode AS BIGINT) AS label, {O.unit_hash_sql('l.pid', REBALANCE)} AS h FROM labels l) x, bal
WHERE CAST(bal.pos AS DOUBLE) / CAST(bal.n AS DOUBLE) >= 0.3 OR x.label = 1
   OR x.h < CAST(floor(bal.wanted / CAST(bal.n - bal.pos AS DOUBLE) * 1152921504606846976.0) AS BIGINT)""",
    "labels", "bal"))
def q_rebalance_negatives_hash(spark, d):
    lab = Tables(spark, d).labels()
    return normalise(op.rebalance_negatives(lab, "label", exact=False, seed=SEED))


O.cte("train_labels", "SELECT l.pid, l.label_in_episode AS label FROM labels l "
      "JOIN train_subjects t ON l.pid = t.pid", "labels", "train_subjects")


@query("rebalance_train_hash", O.sql(
    f"""SELECT l.pid, CAST(l.label AS BIGINT) AS label FROM train_labels l,
  (SELECT count(*) AS n, sum(label) AS pos, CAST(sum(label) AS DOUBLE) / CAST(0.3 AS DOUBLE) * CAST(0.7 AS DOUBLE) AS wanted
   FROM train_labels) b
WHERE CAST(b.pos AS DOUBLE) / CAST(b.n AS DOUBLE) >= 0.3 OR l.label = 1 OR {O.unit_hash_sql('l.pid', REBALANCE)}
  < CAST(floor(b.wanted / CAST(b.n - b.pos AS DOUBLE) * 1152921504606846976.0) AS BIGINT)""", "train_labels"))
def q_rebalance_train_hash(spark, d):
    """The study's large-cohort path: rebalancing after the hash split."""
    train, _ = op.split_hash(Tables(spark, d).labels(), 0.7, SEED)
    return normalise(op.rebalance_negatives(train, "label", exact=False, seed=SEED))


@query("fold_assignment", O.sql(
    f"SELECT pid, CAST({O.unit_hash_sql('pid', FOLD)} % 5 AS BIGINT) AS fold FROM cohort", "cohort"))
def q_fold_assignment(spark, d):
    c = Tables(spark, d).cohort().select("pid")
    return normalise(op.fold_assignment(c, 5, SEED))


_SUB_LEFT = ("SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS seg, "
             "c_nationkey AS nation FROM customer")


@query("subtract_rows", O.sql(
    "SELECT CAST(id AS BIGINT) AS id, seg, CAST(nation AS BIGINT) AS nation FROM l WHERE NOT EXISTS ("
    "SELECT 1 FROM r WHERE l.id IS NOT DISTINCT FROM r.id AND l.seg IS NOT DISTINCT FROM r.seg "
    "AND l.nation IS NOT DISTINCT FROM r.nation)",
    extra=[("l", f"{_SUB_LEFT} UNION ALL {_SUB_LEFT}"), ("r", f"SELECT * FROM ({_SUB_LEFT}) WHERE nation < 5")]))
def q_subtract_rows(spark, d):
    c = fx.table(spark, d, "customer")
    left1 = c.select(F.col("c_custkey").alias("id"),
                     F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
                     .alias("seg"), F.col("c_nationkey").alias("nation"))
    left = left1.unionByName(left1)
    right = left1.filter(F.col("nation") < 5)
    return normalise(op.subtract_rows(left, right))


# =================================================================== models
# Fits depend on solver internals, so the queries return what no solver
# decides. They run on all subjects with few iterations and topics.
SMALL = dict(lda_k=5, lda_iterations=5, svm_iterations=10)


def _study_inputs(spark, d):
    """The study's sets with a hash split and no rebalancing."""
    from .study import inputs_from_tokens, note_tokens
    t = Tables(spark, d)
    tokens = note_tokens(None, None, notes_in_ep=t.notes_in_episode())
    return inputs_from_tokens(tokens, t.scores(), t.flags(), seed=SEED, exact=False, rebalance=False)[0], t


def _cfg():
    from .study import StudyConfig
    return StudyConfig(svm_iterations=SMALL["svm_iterations"], lda_k=SMALL["lda_k"],
                       lda_iterations=SMALL["lda_iterations"], seed=SEED,
                       hours=range(SWEEP[0], SWEEP[1] + 1, SWEEP[2]),
                       topic_hours=range(SWEEP[2], SWEEP[1] + 1, SWEEP[2]))


def _in_range(c: str, low: float = 0.0, high: float = 1.0):
    return F.when(F.col(c).isNull() | F.col(c).between(low, high), 1).otherwise(0).cast("bigint")


def _counts(metrics: DataFrame, *keys: str) -> DataFrame:
    """Keys (-1 for no hour), total, positives and whether the AUC is one."""
    cols = [F.coalesce(k, F.lit(-1)).alias(k) if k == "hour" else F.col(k) for k in keys]
    return normalise(metrics.select(*cols, "total", "positives", _in_range("auc").alias("auc_ok")))


# subjects of the note cohort with their label; its two splits
O.cte("ks", f"SELECT l.pid, l.label_in_episode AS label, {O.unit_hash_sql('l.pid', SPLIT)} AS h, "
      f"{O.unit_hash_sql('l.pid', REBALANCE)} AS rh FROM labels l WHERE l.pid IN (SELECT pid FROM kept_words)",
      "labels", "kept_words")
O.cte("hash_part", f"SELECT pid, label, CASE WHEN h < {hash_threshold(0.7)} THEN 'train' ELSE 'test' END AS split FROM ks", "ks")
O.cte("exact_part", "SELECT pid, label, rh, CASE WHEN row_number() OVER (ORDER BY h, pid) <= "
      "CAST(floor(count(*) OVER () * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM ks", "ks")
O.cte("exact_balanced", """SELECT pid, label, split FROM (
  SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY rh, pid) AS rn, sum(label) OVER (PARTITION BY split) AS pos,
    count(*) OVER (PARTITION BY split) AS n FROM exact_part)
WHERE split = 'test' OR label = 1 OR CAST(pos AS DOUBLE) / CAST(n AS DOUBLE) >= 0.3
  OR rn <= CAST(floor(CAST(pos AS DOUBLE) / CAST(0.3 AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS BIGINT)""", "exact_part")
_N = "count(*) AS total, CAST(sum(label) AS BIGINT) AS positives, CAST(1 AS BIGINT) AS auc_ok"


def _by_split(part: str, among: str | None = None) -> str:
    where = f" WHERE pid IN (SELECT pid FROM {among})" if among else ""
    return f"SELECT split, {_N} FROM {part}{where} GROUP BY split"


def _baseline_counts(part: str) -> str:
    present = "epoch_ms(c.{}) > epoch_ms(f.first_ts) + h.hour * 3600000"
    return (f"SELECT 'train' AS split, CAST(-1 AS BIGINT) AS hour, {_N} FROM {part} "
            f"WHERE split = 'train' AND pid IN (SELECT pid FROM bl) UNION ALL "
            f"SELECT 'test', h.hour, {_N} FROM {part} p JOIN cohort c ON p.pid = c.pid JOIN first f ON p.pid = f.pid, "
            f"range({SWEEP[0]}, {SWEEP[1] + 1}, {SWEEP[2]}) h(hour) WHERE p.split = 'test' "
            f"AND p.pid IN (SELECT pid FROM bl) AND (h.hour <= 0 OR ({present.format('out_ts')} "
            f"AND {present.format('dod')})) GROUP BY h.hour")


def _topic_counts(part: str) -> str:
    """A subject counts from the hour at which it has a term that the train
    subjects' notes have by then."""
    return (f"SELECT v.split, h.hour, {_N} FROM (SELECT t.pid, p.split, any_value(p.label) AS label, "
            f"min(greatest(t.dt, m.dt)) AS since FROM terms t JOIN {part} p ON t.pid = p.pid JOIN ("
            f"SELECT term, min(dt) AS dt FROM terms WHERE pid IN (SELECT pid FROM {part} WHERE split = 'train') GROUP BY term) m "
            f"ON t.term = m.term GROUP BY t.pid, p.split) v, range({SWEEP[2]}, {SWEEP[1] + 1}, {SWEEP[2]}) h(hour) "
            f"WHERE v.since < h.hour * 3600000 GROUP BY v.split, h.hour")


O.cte("terms", "SELECT t.pid, epoch_ms(t.ts) - epoch_ms(f.first_ts) AS dt, unnest(t.tokens) AS term "
      "FROM tok t JOIN first f ON t.pid = f.pid", "tok", "first")


@query("topic_features", O.sql(
    f"SELECT DISTINCT pid, CAST({LDA_K} AS BIGINT) AS topics, 1.0::DOUBLE AS mixture FROM tok WHERE len(tokens) > 0",
    "tok"))
def q_topic_features(spark, d):
    """The study's number of topics and iterations."""
    from .models import topic_features
    inp, _ = _study_inputs(spark, d)
    feats, _ = topic_features(inp.tokens, LDA_K, LDA_ITERATIONS, seed=SEED)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return feats.select("pid", F.size("features").cast("bigint").alias("topics"), F.round(total, 6).alias("mixture"))


@query("topic_top_terms", O.sql(
    f"SELECT t.topic, r.rank, CAST(1 AS BIGINT) AS known FROM range({SMALL['lda_k']}) t(topic), range(10) r(rank)"))
def q_topic_top_terms(spark, d):
    from .models import fit_topics, topic_top_terms
    inp, _ = _study_inputs(spark, d)
    top = topic_top_terms(fit_topics(inp.tokens, SMALL["lda_k"], SMALL["lda_iterations"], seed=SEED), 10)
    words = op.vocabulary(inp.tokens).select("term", F.lit(1).alias("known"))
    return normalise(top.join(words, "term", "left").select("topic", "rank", F.coalesce("known", F.lit(0)).alias("known")))


@query("svm_scores", O.sql(
    "SELECT pid, CAST(label AS DOUBLE) AS label, CAST(1 AS BIGINT) AS scored FROM ks "
    "WHERE pid IN (SELECT pid FROM derived)", "ks", "derived"))
def q_svm_scores(spark, d):
    from .models import fit_svm
    from .study import fit_ready
    inp, t = _study_inputs(spark, d)
    feats = op.derived_features(inp.cohort, inp.scores, inp.flags)
    pts = fit_ready(op.labeled_points_dense(feats, inp.labels))
    model = fit_svm(pts, SMALL["svm_iterations"], 100.0, True)
    fine = F.when(F.abs("score") < float("inf"), 1).otherwise(0).cast("bigint")
    return model.score(pts).select("pid", "label", fine.alias("scored"))


_GRID_ROWS = ", ".join(f"({i}, {int(b)}, {t}, {r})" for i, (b, t, r) in enumerate(
    (b, t, r) for b in DERIVED_GRID["intercept"] for t in DERIVED_GRID["iterations"] for r in DERIVED_GRID["reg"]))


@query("cv_grid", O.sql(
    "SELECT CAST(g AS BIGINT) AS grid_point, CAST(b AS BIGINT) AS intercept, CAST(t AS BIGINT) AS iterations, "
    "CAST(r AS DOUBLE) AS reg, CAST(1 AS BIGINT) AS auc_ok, CAST(1 AS BIGINT) AS winners "
    f"FROM (VALUES {_GRID_ROWS}) v(g, b, t, r)"))
def q_cv_grid(spark, d):
    """The study's 24 grid points of EXP-4, five folds, Spark ML's solver."""
    from .models import cv_grid
    from .study import fit_ready
    inp, _ = _study_inputs(spark, d)
    pts = op.labeled_points_dense(op.derived_features(inp.cohort, inp.scores, inp.flags), inp.labels)
    train = fit_ready(pts.join(inp.train, "pid", "left_semi"))
    out, _ = cv_grid(train, DERIVED_GRID, seed=SEED, parallelism=4)
    winners = out.filter("best").count()
    return normalise(out.select("grid_point", "intercept", "iterations", "reg", _in_range("mean_auc").alias("auc_ok"),
                                F.lit(winners).cast("bigint").alias("winners")))


# ------------------------------------------------- the study's solver, compared number by number
# At reg 100 its weights grow by up to 100 an iteration; these queries use 0.1, the grids all of the study's values.
FIXED_REG = 0.1
# labelled points with a constant last feature
_POINTS = ("SELECT x.pid, list(x.value ORDER BY x.idx) || [1.0::DOUBLE] AS x, CASE WHEN any_value(k.label) > 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END "
           "AS y, any_value(k.label) AS label, any_value(k.split) AS split, {fold} AS fold FROM {features} x JOIN hash_part k ON x.pid = k.pid "
           "GROUP BY x.pid")
_FOLD_SQL = f"CAST({O.unit_hash_sql('x.pid', FOLD)} % 5 AS BIGINT)"
O.cte("wide", _WIDE.format(t="bl"), "bl")


def _fitted(features: str, width: int, train: bool) -> list[tuple[str, str]]:
    """One model of the study's iterations on all points or the train ones."""
    where = " WHERE split = 'train'" if train else ""
    return [("all_pts", _POINTS.format(features=features, fold="0")), ("pts", f"SELECT * FROM all_pts{where}"),
            ("models", f"SELECT 0 AS model, 1.0::DOUBLE AS bias, CAST({FIXED_REG} AS DOUBLE) AS reg, -1 AS held_out, "
                       "(SELECT count(*) FROM pts) AS n"),
            ("walk", O.descent(width, SVM_ITERATIONS))]


def _grid_sql(features: str, width: int, grid: dict) -> str:
    """Mean AUC of every grid point over five folds."""
    rows = list(enumerate((i, t, r) for i in grid["intercept"] for t in grid["iterations"] for r in grid["reg"]))
    pairs = sorted({(i, r) for _, (i, _, r) in rows})
    models = " UNION ALL ".join(
        f"SELECT {p * 5 + f} AS model, CAST({float(i)} AS DOUBLE) AS bias, CAST({r} AS DOUBLE) AS reg, {f} AS held_out, "
        f"(SELECT count(*) FROM pts WHERE fold <> {f}) AS n" for p, (i, r) in enumerate(pairs) for f in range(5))
    points = ", ".join(f"({g}, {int(i)}, {t}, {float(r)}, {pairs.index((i, r))})" for g, (i, t, r) in rows)
    scored = ("SELECT w.t, w.model, list_dot_product(p.x, w.w) AS score, p.label FROM walk w JOIN models m ON w.model = m.model "
              f"JOIN pts p ON p.fold = m.held_out WHERE w.t IN ({', '.join(map(str, grid['iterations']))})")
    return O.sql(f"""SELECT CAST(g.grid_point AS BIGINT) AS grid_point, CAST(g.intercept AS BIGINT) AS intercept,
  CAST(g.iterations AS BIGINT) AS iterations, CAST(g.reg AS DOUBLE) AS reg, mean_auc,
  CAST(CASE WHEN row_number() OVER (ORDER BY mean_auc DESC NULLS LAST, grid_point) = 1 THEN 1 ELSE 0 END AS BIGINT) AS best
FROM (VALUES {points}) g(grid_point, intercept, iterations, reg, pair)
JOIN (SELECT t, pair, list_reduce(list(auc ORDER BY fold), lambda a, b: a + b) / count(auc) AS mean_auc
      FROM (SELECT model // 5 AS pair, model % 5 AS fold, t, auc FROM ({auc_sql('scored', 't, model')}) WHERE auc IS NOT NULL)
      GROUP BY t, pair) a
ON a.t = g.iterations AND a.pair = g.pair""", features, "hash_part", recursive=True,
                 extra=[("pts", f"SELECT * FROM ({_POINTS.format(features=features, fold=_FOLD_SQL)}) WHERE split = 'train'"),
                        ("models", models), ("walk", O.descent(width, max(grid["iterations"]))), ("scored", scored)])


def _train_points(spark, d, features) -> DataFrame:
    from .study import fit_ready
    inp, _ = _study_inputs(spark, d)
    pts = op.labeled_points_dense(features(inp), inp.labels)
    return fit_ready(op.restrict_to_subjects(pts, inp.train))


def _graded(out: DataFrame) -> DataFrame:
    return normalise(out.select("grid_point", "intercept", "iterations", "reg", "mean_auc", "best"))


@query("svm_weights", O.sql(
    "SELECT CAST(j - 1 AS BIGINT) AS idx, round(w[j], 9) AS value FROM walk, range(1, 35) r(j) WHERE t = "
    f"{SVM_ITERATIONS} UNION ALL SELECT -1, auc FROM (" + auc_sql("scored") + ")", "derived", "hash_part", recursive=True,
    extra=[*_fitted("derived", 33, False),
           ("scored", f"SELECT list_dot_product(p.x, w.w) AS score, p.label FROM pts p, walk w WHERE w.t = {SVM_ITERATIONS}")]))
def q_svm_weights(spark, d):
    """Weights of the study's solver (intercept last) and, as -1, their AUC."""
    from .study import fit_ready
    from .subgradient import fit_svm_subgradient
    inp, _ = _study_inputs(spark, d)
    pts = fit_ready(op.labeled_points_dense(op.derived_features(inp.cohort, inp.scores, inp.flags), inp.labels))
    m = fit_svm_subgradient(pts, SVM_ITERATIONS, FIXED_REG)
    weights = spark.createDataFrame([(j, w) for j, w in enumerate([*m.weights, m.intercept])], "idx bigint, value double")
    auc = op.auc_by_rank(m.score(pts)).select(F.lit(-1).cast("bigint").alias("idx"), F.col("auc").alias("value"))
    return weights.select("idx", F.round("value", 9).alias("value")).unionByName(auc)


@query("cv_grid_baseline", _grid_sql("wide", 3, BASELINE_GRID))
def q_cv_grid_baseline(spark, d):
    """The study's 15 grid points of EXP-1, five folds."""
    from .subgradient import cv_grid_subgradient
    pts = _train_points(spark, d, lambda inp: op.baseline_features_wide(inp.cohort, inp.scores))
    return _graded(cv_grid_subgradient(pts, BASELINE_GRID, seed=SEED)[0])


@query("cv_grid_derived", _grid_sql("derived", 33, DERIVED_GRID))
def q_cv_grid_derived(spark, d):
    """The study's 24 grid points of EXP-4, five folds."""
    from .subgradient import cv_grid_subgradient
    pts = _train_points(spark, d, lambda inp: op.derived_features(inp.cohort, inp.scores, inp.flags))
    return _graded(cv_grid_subgradient(pts, DERIVED_GRID, seed=SEED)[0])


def _solver_cfg():
    from dataclasses import replace
    return replace(_cfg(), solver="subgradient", svm_iterations=SVM_ITERATIONS, baseline_reg=FIXED_REG, derived_reg=FIXED_REG)


def _split_auc(src: str, by: str) -> str:
    keys = [k.strip() for k in by.split(",")]
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM t.{k}" for k in keys)
    cols = ", ".join(f"a.{k}" for k in keys)
    return (f"SELECT {cols}, t.total, t.positives, a.auc FROM ({auc_sql(src, by)}) a JOIN (SELECT {by}, count(*) AS total, "
            f"CAST(sum(label) AS BIGINT) AS positives FROM {src} GROUP BY {by}) t ON {on}")


@query("derived_model_auc", O.sql(
    _split_auc("scored", "split"), "derived", "hash_part", recursive=True,
    extra=[*_fitted("derived", 33, True),
           ("scored", f"SELECT p.split, list_dot_product(p.x, w.w) AS score, p.label FROM all_pts p, walk w WHERE w.t = {SVM_ITERATIONS}")]))
def q_derived_model_auc(spark, d):
    """EXP-4 with the study's solver: the AUC itself."""
    from .study import derived_model
    inp, _ = _study_inputs(spark, d)
    return normalise(derived_model(inp, _solver_cfg()).select("split", "total", "positives", "auc"))


@query("baseline_model_auc", O.sql(
    _split_auc("scored", "split, hour"), "wide", "hash_part", "cohort", "first", recursive=True,
    extra=[*_fitted("wide", 3, True),
           ("subject_score", f"SELECT p.pid, p.split, list_dot_product(p.x, w.w) AS score, p.label FROM all_pts p, walk w WHERE w.t = {SVM_ITERATIONS}"),
           ("scored", f"""SELECT split, CAST(-1 AS BIGINT) AS hour, score, label FROM subject_score WHERE split = 'train' UNION ALL
SELECT s.split, h.hour, s.score, s.label FROM subject_score s JOIN cohort c ON s.pid = c.pid JOIN first f ON s.pid = f.pid,
range({SWEEP[0]}, {SWEEP[1] + 1}, {SWEEP[2]}) h(hour) WHERE s.split = 'test' AND (h.hour <= 0
  OR (epoch_ms(c.out_ts) > epoch_ms(f.first_ts) + h.hour * 3600000 AND epoch_ms(c.dod) > epoch_ms(f.first_ts) + h.hour * 3600000))""")]))
def q_baseline_model_auc(spark, d):
    """EXP-1 with the study's solver: the AUC of every hour mark."""
    from .study import baseline_model
    inp, _ = _study_inputs(spark, d)
    out = baseline_model(inp, _solver_cfg())[0]
    return normalise(out.select("split", F.coalesce("hour", F.lit(-1)).alias("hour"), "total", "positives", "auc"))


@query("hourly_auc_fitted", O.sql(_baseline_counts("hash_part"), "hash_part", "bl", "cohort", "first"))
def q_hourly_auc_fitted(spark, d):
    from .study import baseline_model
    inp, _ = _study_inputs(spark, d)
    return _counts(baseline_model(inp, _cfg())[0], "split", "hour")


@query("retrospective_topic_model", O.sql(_by_split("hash_part"), "hash_part"))
def q_retrospective_topic_model(spark, d):
    from .study import retrospective_topic_model
    inp, _ = _study_inputs(spark, d)
    return _counts(retrospective_topic_model(inp, _cfg()), "split")


@query("hourly_topic_model", O.sql(_topic_counts("hash_part"), "hash_part", "terms"))
def q_hourly_topic_model(spark, d):
    from .study import hourly_topic_model
    inp, _ = _study_inputs(spark, d)
    return _counts(hourly_topic_model(inp, _cfg()), "split", "hour")


@query("derived_model", O.sql(_by_split("hash_part", "derived"), "hash_part", "derived"))
def q_derived_model(spark, d):
    from .study import derived_model
    inp, _ = _study_inputs(spark, d)
    return _counts(derived_model(inp, _cfg()), "split")


@query("study_summary", O.sql(
    f"SELECT 'baseline' AS experiment, * FROM ({_baseline_counts('exact_balanced')}) UNION ALL "
    f"SELECT 'retrospective_topics', split, -1, total, positives, auc_ok FROM ({_by_split('exact_balanced')}) UNION ALL "
    f"SELECT 'derived', split, -1, total, positives, auc_ok FROM ({_by_split('exact_part', 'derived')}) UNION ALL "
    f"SELECT 'hourly_topics', * FROM ({_topic_counts('exact_part')})",
    "exact_balanced", "exact_part", "bl", "cohort", "first", "derived", "terms"))
def q_study_summary(spark, d):
    """All experiments on an exact split, rebalanced as in the study."""
    from .study import build_inputs, run_study, study_summary
    t = Tables(spark, d)
    inputs = build_inputs(spark, t.subjects(), t.episodes(), t.notes(with_text=False), t.scores(), t.flags(), seed=SEED,
                          attach=lambda notes: fx.attach_text(spark, d, notes))
    return _counts(study_summary(run_study(inputs, _cfg())), "experiment", "split", "hour")
