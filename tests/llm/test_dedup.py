"""Line dedup, substring dedup, Jaccard join, components."""
import random

import pytest
from pyspark.sql import functions as F

from cohortlab.llm.catalog import QUERIES
from cohortlab.llm.components import connected_components
from cohortlab.llm.jaccard_join import jaccard_components, jaccard_link_counts, jaccard_links, jaccard_report
from cohortlab.llm.line_dedup import dropped_lines, line_dedup, line_dedup_report, within_one_edit
from cohortlab.llm.substring_dedup import passage_report, without_passages

from . import brute


def near_docs(rnd, n, length, rate):
    """Documents of which some are edited copies of earlier ones."""
    docs = []
    for i in range(n):
        if docs and rnd.random() < 0.6:
            w = list(rnd.choice(docs)[1].split())
            for _ in range(rnd.randrange(1 + int(len(w) * rate))):
                k = rnd.randrange(len(w))
                w[k:k + 1] = rnd.choice([[], [f"n{rnd.randrange(99)}"], [w[k], f"n{rnd.randrange(99)}"]])
                w = w or ["x"]
        else:
            w = [f"w{rnd.randrange(500)}" for _ in range(rnd.randrange(1, length))]
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(make_docs, seed):
    docs = near_docs(random.Random(seed), 150, 60, 0.1)
    want = brute.jaccard(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_report(make_docs(docs)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(docs)


def test_jaccard_exact_threshold(make_docs):
    """8 of 10 shingles links; 4 of 6 does not."""
    a = [f"a{i}" for i in range(13)]
    docs = [(5, " ".join(a)), (3, " ".join(["zz", *a[:12]])), (8, " ".join([*a, "q"])), (9, " ".join(a[:9])), (10, " ".join(a[1:10]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_report(make_docs(docs)).collect()}
    assert got == brute.jaccard(docs)
    assert got[5][1] == got[3][1] == got[8][1] == 3 and got[9][1] == 9


def test_jaccard_hot_groups(make_docs, spark):
    """A star of near copies of one text: the centre links them, many do not
    link with each other; groups, salts and leaders all come into play."""
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    docs = [(0, " ".join(base))]
    for i in range(1, 140):
        w = list(base)
        for k in rnd.sample(range(0, 115, 6), rnd.randrange(1, 6)):
            w[k] = f"x{i}_{k}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(base)) for i in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard_components(make_docs(docs), group_size=4).select(F.col("id").alias("doc_id"), "n_shingles", "component_id").collect()}
    assert got == brute.jaccard(docs)


def test_jaccard_links_are_all_found(make_docs):
    """Every pair inside groups of near copies, with copies and empty texts."""
    rnd = random.Random(5)
    docs = near_docs(rnd, 120, 60, 0.1)
    base = [f"b{i}" for i in range(120)]
    for i in range(200, 260):
        w = list(base)
        for k in rnd.sample(range(0, 115, 6), rnd.randrange(1, 3)):
            w[k] = f"x{i}_{k}"
        docs.append((i, " ".join(w)))
    docs += [(300, None), (301, ""), (302, docs[0][1]), (302, docs[0][1])]
    sets = [brute.shingles(t) for _, t in docs]
    linked = [[100 * len(a & b) >= 80 * len(a | b) and bool(a) and m != n for n, b in enumerate(sets)] for m, a in enumerate(sets)]
    got = jaccard_link_counts(make_docs(docs), group_size=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.n_links) for r in got) == \
        sorted((i, len(s), sum(x)) for (i, _), s, x in zip(docs, sets, linked))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.jaccard(docs)
    classes, links = jaccard_links(make_docs(docs), group_size=4)
    of = {r.id: r.cls for r in classes.collect()}
    want = {(min(of[i], of[j]), max(of[i], of[j])) for (i, _), x in zip(docs, linked) for (j, _), y in zip(docs, x) if y and of[i] != of[j]}
    pairs = [(r.u, r.v) for r in links.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 250
    assert jaccard_link_counts(make_docs(docs).limit(0)).count() == 0


def test_jaccard_odd_rows(make_docs, spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    docs = [(7, None), (8, ""), (9, " \n "), (4, "One two"), (3, "one TWO"), (5, "one two three"), (12, long), (11, long + " end"),
            (6, "É one two three four"), (2, "é one two three four")]
    df = make_docs(docs).withColumn("component_id", F.lit("x")).withColumn("cls", F.lit(0)).withColumn("id", F.lit("y"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_report(df).collect()}
    assert got == brute.jaccard(docs)
    assert got[4] == (1, 3) and got[12][1] == 11 and got[7] == (0, 7) and got[6][1] == 6
    twice = jaccard_report(make_docs([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "z")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in twice) == [("1", "1"), ("1", "1"), ("None", "1"), ("None", "None")]
    assert jaccard_report(df.limit(0)).count() == 0


def test_jaccard_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_ngram_jaccard_join"](spark, sf_dir).collect()}
    assert got == brute.jaccard(docs)


@pytest.mark.parametrize("local", [10**6, 0])
def test_components(spark, monkeypatch, local):
    from cohortlab.llm import components
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    rnd = random.Random(2)
    edges = [(rnd.randrange(300) - 50, rnd.randrange(300) - 50) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)] + \
            [(5000, x) for x in range(5001, 5300)]
    u = brute.Union()
    for a, b in edges:
        u.join(a, b)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {x: u.find(x) for x in got}
    assert set(got) == {x for e in edges for x in e if e[0] != e[1]}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_within_one_edit():
    a = list("abcdefgh")
    for b, want in ((a, True), (a[:-1], True), (a[1:], True), ([*a, "x"], True), (["x", *a[1:]], True), (a[2:], False),
                    (["b", "a", *a[2:]], False), ([], False), (["x", *a[:-1]], False)):
        assert within_one_edit(a, b) == want == brute.one_edit(a, b)


def test_lines_equal_brute_force(make_docs):
    rnd = random.Random(6)
    pool = [[f"w{rnd.randrange(9)}" for _ in range(rnd.randrange(1, 14))] for _ in range(40)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randrange(0, 6)):
            w = list(rnd.choice(pool))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                k = rnd.randrange(len(w) + 1)
                w[k:k + rnd.randrange(2)] = rnd.choice([[], [f"w{rnd.randrange(9)}"]])
            lines.append(rnd.choice([" ", "  "]).join(w))
        docs.append((i, "\n".join(lines)))
    want = brute.dropped_lines(docs)
    got = {r.doc_id: r.dropped for r in line_dedup_report(make_docs(docs)).collect()}
    assert got == {i: ",".join(map(str, w)) for (i, _), w in zip(docs, want)}
    assert sum(map(len, want)) > 60
    texts = {r.doc_id: r.text for r in line_dedup(make_docs(docs)).collect()}
    assert texts == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in w) for (i, t), w in zip(docs, want)}


def test_line_dedup_odd_rows(make_docs):
    line = "one two three four five six seven eight"
    docs = [(2, line + "\nshort\n\n"), (1, line.replace("three", "3") + "\n\nshort"), (3, None), (4, ""), (5, "\n\n"),
            (None, line + " nine"), (6, " ".join(f"x{i}" for i in range(20_000))), (7, " ".join(f"x{i}" for i in range(20_001)))]
    df = make_docs(docs).withColumn("id", F.lit(1)).withColumn("tkey", F.lit("t")).withColumn("dropped", F.lit(0)) \
        .withColumn("line", F.lit(2))
    got = {r.doc_id: r.dropped for r in line_dedup_report(df).collect()}
    assert got == {1: "", 2: "0,1", 3: "", 4: "", 5: "", None: "0", 6: "", 7: "0"}
    out = line_dedup(df)
    assert out.columns == [*df.columns, "__ld_dropped"]
    assert {r.doc_id: r.text for r in out.collect()}[2] == "\n"
    same = line_dedup_report(make_docs([(1, line), (1, line), (2, line)])).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in same) == [(1, 0), (1, 0), (2, 1)]
    assert dropped_lines(df.limit(0)).count() == 0


def test_line_dedup_without_broadcast(make_docs, monkeypatch):
    from cohortlab.llm import line_dedup as L
    monkeypatch.setattr(L, "small_side", lambda df, rows=0: df)
    docs = [(i, f"alpha beta gamma delta epsilon zeta eta theta {i % 3}\nline {i % 5}") for i in range(30)]
    got = {r.doc_id: r.dropped for r in L.line_dedup_report(make_docs(docs)).collect()}
    assert got == {i: ",".join(map(str, w)) for (i, _), w in zip(docs, brute.dropped_lines(docs))}


def passage_docs(words, rnd, n, size):
    shared = [" ".join(words(size)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [" ".join(words(rnd.randrange(5, 90))) for _ in range(3)]
        if rnd.random() < 0.7:
            parts.insert(rnd.randrange(4), rnd.choice(shared))
        docs.append((i, "\n".join(parts)))
    return docs


@pytest.mark.parametrize("size", [51, 70])
def test_repeated_passages_are_found(make_docs, words, size):
    docs = passage_docs(words, random.Random(size), 80, size)
    got = passage_report(make_docs(docs)).collect()
    assert {r.doc_id for r in got} == brute.passages(docs)
    assert all(r.first_doc_id < r.doc_id for r in got)


def test_passages_between_near_copies(make_docs, words):
    """The only earlier holder of the passage is inside a run that another
    stretch proves, and is the first of none of its chunks."""
    rnd, docs = random.Random(3), []
    for g in range(6):
        base = words(200, 10**9)
        edited = [[*base[:30], f"e{g}", *base[31:]], [*base[:50], f"f{g}", *base[51:80]], base, [*words(9, 10**9), *base[9:72], *words(9, 10**9)]]
        docs += [(10 * g + k, " ".join(w)) for k, w in enumerate(edited, 1)]
    for g in range(8):
        base = words(160, 10**9)
        for k in range(30):
            a = rnd.randrange(100)
            w = base[a: a + rnd.randrange(52, 160)]
            for _ in range(rnd.randrange(5)):
                w[rnd.randrange(len(w))] = f"x{g}_{rnd.randrange(10**6)}"
            docs.append((1000 + 100 * g + k, " ".join([*words(rnd.randrange(9), 10**9), *w, *words(rnd.randrange(9), 10**9)])))
    got = passage_report(make_docs(docs)).collect()
    assert {10 * g + 4 for g in range(6)} <= brute.passages(docs)
    assert {r.doc_id for r in got} == brute.passages(docs)


def test_shorter_repeats_are_left_alone(make_docs, words):
    docs = passage_docs(words, random.Random(9), 60, 50)
    assert not brute.passages(docs)
    assert passage_report(make_docs(docs)).count() == 0


def test_passages_resist_insertions_and_odd_rows(make_docs, words):
    long = words(70_000, 10**9)
    block = " ".join(long)
    docs = [(1, block), (2, "é inserted here " + " ".join(long[:300]) + " extra " + " ".join(long[300:])), (3, None), (4, ""),
            (5, "a " * 500), (6, "a " * 500), (None, " ".join(long[:80])), (7, "x" * 100_000)]
    df = make_docs(docs).withColumn("id", F.lit(1)).withColumn("chunks", F.lit(1)).withColumn("start", F.lit(0))
    got = passage_report(df).collect()
    assert {r.doc_id for r in got} == {2, 6, None}
    assert {r.first_doc_id for r in got if r.doc_id in (2, None)} == {1}
    assert sum(r.n_words for r in got if r.doc_id == 2) > 0.99 * len(long)
    texts = {r.doc_id: r.text for r in without_passages(df).collect()}
    assert texts[1] == block and len(texts[2].split()) < 100 and texts[2].startswith("é inserted") and texts[3] is None
    assert passage_report(df.limit(0)).count() == 0
    twice = passage_report(make_docs([(1, block), (1, block), (2, block)])).collect()
    assert {r.doc_id for r in twice} == {2}


def test_passage_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert {r.doc_id for r in QUERIES["op4_substring_dedup"](spark, sf_dir).collect()} == brute.passages(docs)
