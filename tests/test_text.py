from pyspark.sql import functions as F

from cohortlab import operators as op
from cohortlab.functions.textcols import clean_text


def _tokens(spark, text, stop=None):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return op.tokenize(df, "text", stop).first()["tokens"]


def test_token_rules(spark):
    toks = _tokens(spark, "Stable|ok abc1def résumé doesn't the cat\twalked\nhome, quickly-running x9 ABCD", [])
    assert "stable|ok" not in toks and "abc1def" not in toks
    assert "résumé" in toks
    assert "doesn" in toks          # the apostrophe becomes a space
    assert "walked" in toks and "home" in toks and "quickly" in toks and "running" in toks
    assert "abcd" in toks           # lower-cased
    assert "cat" not in toks        # three letters are dropped


def test_stop_words_exact_and_repeats_kept(spark):
    toks = _tokens(spark, "would would maybe maybe Would", ["would"])
    assert toks == ["maybe", "maybe"]


def test_default_stop_words_match_spark(spark):
    from pyspark.ml.feature import StopWordsRemover
    from cohortlab.constants import DEFAULT_STOP_WORDS
    assert list(DEFAULT_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_clean_text_special_class(spark):
    df = spark.createDataFrame([("a|b [x] y−z 3rd ok_go",)], "t string")
    out = df.select(clean_text("t").alias("c")).first()["c"]
    assert "|" in out and "[" not in out and "−" not in out and "3rd" not in out and "_" not in out


def test_min_words_boundary(spark):
    rows = [(1, 1, " ".join(["word"] * 99)), (2, 2, " ".join(["word"] * 100))]
    df = spark.createDataFrame(rows, "pid long, hadm long, text string")
    tok = op.tokenize(df, "text", [])
    got = [r["pid"] for r in op.min_word_subjects(tok, 100).collect()]
    assert got == [2]


def test_term_counts_and_vocabulary(spark):
    df = spark.createDataFrame([(1, "alpha beta alpha"), (2, "beta gamma")], "doc_id long, text string")
    tok = op.tokenize(df, "text", [])
    tc = {(r["doc_id"], r["term"]): r["n"] for r in op.term_counts(tok).collect()}
    assert tc == {(1, "alpha"): 2, (1, "beta"): 1, (2, "beta"): 1, (2, "gamma"): 1}
    voc = {r["term"]: r["n"] for r in op.vocabulary(tok).collect()}
    assert voc == {"alpha": 2, "beta": 2, "gamma": 1}


def test_dense_index_is_consecutive(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k")).repartition(7)
    idx = sorted((r["k"], r["idx"]) for r in op.dense_index(df, ["k"]).collect())
    assert [i for _, i in idx] == list(range(500))
    assert all(k == i for k, i in idx)


def test_stop_words_from_word_file(spark):
    import os
    import tempfile
    from cohortlab.sources import read_word_list
    d = tempfile.mkdtemp(prefix="cohortlab-stop-")
    with open(os.path.join(d, "stop.txt"), "w") as f:
        f.write("alpha\nbeta\nalpha\ndoesn't\n")
    stop = read_word_list(spark, os.path.join(d, "stop.txt"))
    toks = _tokens(spark, "alpha beta gamma delta doesn't", stop)
    assert toks == ["gamma", "delta", "doesn"]   # the apostrophe entry can never match


def test_dense_index_across_many_partitions(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3).alias("g"))
        out = op.dense_index(df, ["g", "k"], out="i").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = sorted((r["g"], r["k"], r["i"]) for r in out)
    assert [i for _, _, i in got] == list(range(5000))


def test_stop_words_by_join_keep_rows_order_and_repeats(spark):
    rows = [(1, "gamma beta gamma alpha"), (2, "alpha alpha"), (3, ""), (4, None), (1, "gamma beta gamma alpha")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stop = spark.createDataFrame([("alpha",), ("alpha",), (None,), ("xx",)], "w string")
    got = sorted((r["doc_id"], r["tokens"]) for r in op.tokenize(df, "text", stop).collect())
    plain = sorted((r["doc_id"], r["tokens"] or []) for r in op.tokenize(df, "text", ["alpha", "xx"]).collect())
    assert got == plain and got[0] == (1, ["gamma", "beta", "gamma"]) and len(got) == 5


def test_stop_word_tables_of_any_size(spark, monkeypatch):
    """The list itself, its words in use, or a join: the same tokens."""
    from cohortlab.operators import text as T
    docs = spark.createDataFrame([(1, "heart lungs heart kidney"), (2, ""), (3, None), (4, "lungs lungs"), (4, "lungs lungs")],
                                 "doc_id long, text string")
    words = spark.createDataFrame([("lungs",), ("lungs",), (None,), *((f"other{i}",) for i in range(30))], "word string")
    want = [(1, ["heart", "heart", "kidney"]), (2, []), (3, []), (4, []), (4, [])]
    for limit, listed in ((1000, 31), (5, 1), (0, None)):
        monkeypatch.setattr(T, "LOOKUP_WORDS", limit)
        raw = op.tokenize(docs, stopwords=[])
        found = T._words_in_use(words, raw, "tokens")
        assert (found if found is None else len(found)) == listed
        assert sorted((r["doc_id"], r["tokens"]) for r in op.tokenize(docs, stopwords=words).collect()) == want


def test_without_words_looks_lost_terms_up(spark):
    """Repeats, order, empty rows and rows that lose nothing; no comparison of every token with every lost one."""
    from cohortlab.operators.text import _without_words
    rows = [(1, ["a", "b", "a", "c", "b"]), (2, ["c", "d"]), (3, []), (4, ["b"]), (5, None)]
    df = spark.createDataFrame(rows, "id long, raw array<string>")
    out = _without_words(df, "raw", "kept", spark.createDataFrame([("b",), ("a",), (None,), ("x",)], "w string"))
    assert {r["id"]: r["kept"] for r in out.collect()} == {1: ["c"], 2: ["c", "d"], 3: [], 4: [], 5: None}
    assert "array_contains" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_word_tokens_are_the_passes_in_order(spark):
    """One split against the passes of the study, on characters that meet in odd ways; texts are not replaced twice."""
    import random

    from cohortlab.functions import textcols as tc
    rnd = random.Random(7)
    odd = [*"abcXYZkK019_|. -/'^`:\t\n\x0b\f\r\x00\x1c\x7f{}~[]\\@\x85\xa0éÉßΣσςΑΩİıÅ−–“年дЖ²½ǅⅠⒶ", "K", "\U0001d400", "\U00010400", "abcd", "Wort"]
    texts = ["".join(rnd.choice(odd) for _ in range(rnd.randrange(40))) for _ in range(3000)]
    texts += ["".join(rnd.choice("abK1._ -'|") for _ in range(30)) for _ in range(1000)]
    texts += ["".join(rnd.choice("abΣςΑß1._ -'K") for _ in range(30)) for _ in range(1000)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", None]], "text string").repartition(4)
    new, passes = tc.word_tokens("text"), F.filter(tc.raw_tokens("text"), tc.keep_token)
    assert df.filter(~new.eqNullSafe(passes)).count() == 0
    assert df.select(F.sum(F.size(new))).first()[0] > 1000
    assert r"\w*\d\w*" not in df.select(new)._jdf.queryExecution().optimizedPlan().toString()
