"""Decontamination, packing, embeddings, transcripts, pipeline."""
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlab.llm import embedding_dedup as E
from cohortlab.llm import transcripts as T
from cohortlab.llm.catalog import ORACLE, QUERIES
from cohortlab.llm.decontaminate import covered, decontaminate
from cohortlab.llm.packing import best_fit_pack, pack_shard

from . import brute

ITEMS = "item_id long, text string"


def flags(rows):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontamination_equals_brute_force(make_docs, spark, block):
    rnd = random.Random(block)
    items = [(i, " ".join(f"w{rnd.randrange(30)}" for _ in range(rnd.randrange(1, 30)))) for i in range(25)]
    items += [(100, "W1 w2-w3, É4"), (100, "w9"), (None, "w1 w1 w1"), (101, None), (102, "..."), (103, items[0][1])]
    docs = [(i, " ".join(f"w{rnd.randrange(30)}" for _ in range(rnd.randrange(0, 60)))) for i in range(80)]
    for i in range(40):
        w = docs[i][1].split()
        k = rnd.randrange(len(w) + 1)
        docs[i] = (i, " ".join(w[:k] + [rnd.choice(items)[1] or ""] + w[k:]))
    docs += [(200, None), (201, ""), (202, "?!"), (None, items[3][1]), (203, items[4][1]), (203, items[4][1]),
             (204, (items[5][1] + " x ") * 3000), (205, "\x00w9\x00"), (206, "W1\tW2 w3 é4 É4")]
    df = make_docs(docs).withColumn("n_hit", F.lit("x")).withColumn("item_id", F.lit(1))
    got = flags(decontaminate(df, spark.createDataFrame(items, ITEMS), block_shingles=block).collect())
    want = sorted((str(d[0]), *w) for d, w in zip(docs, brute.decontaminate(docs, items)))
    assert got == want
    assert any(w[-1] for w in want)


def test_decontamination_empty_tables(make_docs, spark):
    df = make_docs([(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], ITEMS)
    assert [r.contaminated for r in decontaminate(df, none).collect()] == [False, False]
    assert decontaminate(df.limit(0), spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0
    assert covered([5, 8, 0, 2, 7, 9, 1, 2]) == 6


def test_decontamination_query(spark, sf_dir):
    def rows(name, key):
        return [(r[key], r.text) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]
    docs = rows("documents", "doc_id")
    got = flags(QUERIES["op6_decontaminate"](spark, sf_dir).collect())
    assert got == sorted((str(d[0]), *w) for d, w in zip(docs, brute.decontaminate(docs, rows("benchmark", "item_id"))))


def test_pack_shard_equals_plain_best_fit():
    rnd = random.Random(3)
    for cap in (10, 50, 200):
        items = sorted(((rnd.randrange(0, cap), rnd.choice([1, 1, 1, 2, 3, None, rnd.randrange(99)]), rnd.choice([None, 7, rnd.randrange(400)]))
                        for _ in range(300)), key=lambda x: -x[0])
        assert [b for b, _ in pack_shard(items, cap)] == brute.best_fit(items, cap)


def pack(df, **more):
    return best_fit_pack(df, size=F.octet_length("text"), source=F.col("source"), cluster=F.xxhash64("text"), **more)


def check_bins(rows, docs, capacity):
    by_bin, sizes = {}, {}
    for r in rows:
        by_bin.setdefault(r.bin_id, []).append(r)
        sizes.setdefault(r.doc_id, []).append(r.n)
    for own in by_bin.values():
        own.sort(key=lambda r: r.start)
        at = 0
        for r in own:
            assert r.start == at
            at += r.n
        assert at <= capacity
    want = {}
    for i, t in docs:
        want[i] = want.get(i, 0) + len((t or "").encode())
    assert {i: sum(n) for i, n in sizes.items()} == want
    return by_bin


def test_packing(make_docs):
    rnd = random.Random(8)
    docs = [(i, "x" * rnd.randrange(0, 260), "en", rnd.choice(["hot", "hot", "a", "b", "c"])) for i in range(400)]
    docs += [(1000 + i, "same text", "en", f"s{i}") for i in range(30)]
    source = {d[0]: d[3] for d in docs}
    text = {d[0]: d[1] for d in docs}
    for shard in (50, 4096):
        rows = pack(make_docs(docs), capacity=100, shard_rows=shard).collect()
        for own in check_bins(rows, [d[:2] for d in docs], 100).values():
            if len(own) > 1:
                assert len({source[r.doc_id] for r in own}) == len(own)
                assert len({text[r.doc_id] for r in own}) == len(own)


def test_packing_odd_rows(make_docs):
    docs = [(2**62 + 1, None), (2, ""), (3, "a" * 100), (4, "b" * 250), (5, "c" * 99), (5, "c" * 99), (None, "d" * 30), (6, "e" * 50_000)]
    df = make_docs(docs).withColumn("source", F.lit(None).cast("string")).withColumn("n", F.lit("x")).withColumn("shard", F.lit(0))
    rows = pack(df, capacity=100).collect()
    bins = check_bins(rows, docs, 100)
    assert len([r for r in rows if r.doc_id == 5]) == 2 and len({r.bin_id for r in rows if r.doc_id == 5}) == 2
    assert sum(r.n for r in rows if r.doc_id == 6) == 50_000 and len(bins) >= 503
    assert pack(df.limit(0)).count() == 0


def test_packing_sizes_of_one_id(make_docs):
    docs = [(7, "x" * 250), (7, "y" * 350), (8, "z" * 100)]
    rows = best_fit_pack(make_docs(docs), size=F.octet_length("text"), source=F.col("source"), cluster=F.lit(None).cast("bigint"),
                         capacity=100).collect()
    check_bins(rows, docs, 100)


def test_null_texts_share_a_bin(make_docs, spark, tmp_path):
    import corpus_pipeline as P
    docs = make_docs([(i, None, "en", f"s{i}") for i in range(40)] + [(100 + i, "same", "en", f"t{i}") for i in range(3)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for rows in (QUERIES["op7_best_fit_packing"](spark, str(tmp_path)).collect(), P.packing_stage(spark, docs, str(tmp_path)).collect()):
        assert len(rows) == 43 and len({r.bin_id for r in rows}) == 3
        assert len({r.bin_id for r in rows if r.doc_id < 100}) == 1


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def near_vectors(rnd, n, dim=16):
    out = []
    for i in range(n):
        if out and rnd.random() < 0.5:
            v = out[rnd.integers(len(out))][1] + rnd.normal(size=dim) * rnd.choice([0, 0.03, 0.1])
        else:
            v = rnd.normal(size=dim)
        out.append((i, v.astype(np.float32), int(rnd.choice([0, 0, 0, 1, 2]))))
    return out


def exact_links(rows):
    links, u = {i: 0 for i, _, _ in rows}, brute.Union()
    for n, (i, a, x) in enumerate(rows):
        for j, b, y in rows[:n]:
            a64, b64 = np.asarray(a, float), np.asarray(b, float)
            if x == y and a64 @ b64 / np.linalg.norm(a64) / np.linalg.norm(b64) >= 0.98:
                links[i] += 1
                links[j] += 1
                u.join(i, j)
    return links, u


def test_embedding_links_against_brute_force(spark):
    rows = near_vectors(np.random.default_rng(3), 500)
    links, u = exact_links(rows)
    got = {r.vec_id: r for r in E.embedding_dedup(vectors(spark, [(i, v.tolist(), x) for i, v, x in rows]), shard_rows=64).collect()}
    assert len(got) == len(rows)
    found, there = sum(r.n_links for r in got.values()), sum(links.values())
    assert found <= there and found >= 0.9 * there and there > 200
    for i, r in got.items():
        assert r.n_links <= links[i] and r.kept == (r.vec_id == r.component_id)
        assert u.find(r.component_id) == u.find(i)
    assert np.mean([got[i].component_id == u.find(i) for i in got]) >= 0.95


def test_embedding_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [0.0, 0.0], 0),
            (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [1.0, 0.0], 0), (10, [1.0, 0.0], 0), (None, [1.0, 0.0], 0),
            (11, [1.0, 0.0, 0.0], 0), (12, [], 0), (13, [-1.0, 0.0], 0), (14, [3e38, 3e38], 0), (15, [1.0, 1.0], 0)]
    df = vectors(spark, rows).withColumn("node", F.lit(1)).withColumn("v", F.lit("x")).withColumn("n_links", F.lit(0))
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.embedding_dedup(df).collect()), key=str)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11, 12, 13)]
    want = alone + [(1, 4, 1, True), (2, 4, 1, False), (10, 4, 1, False), (10, 4, 1, False), (None, 4, 1, True)] + \
        [(14, 1, 14, True), (15, 1, 14, False)]
    want = [w if w[0] is not None else (None, 4, 1, got[[g[0] for g in got].index(None)][3]) for w in want]
    assert got == sorted(want, key=str)
    assert E.embedding_dedup(df.limit(0)).count() == 0


def test_embedding_components_of_any_size(spark):
    rows = [(1, [1.0, 1.0], 0), (2, [1e200, 1e200], 0), (3, [1e-200, 1e-200], 0), (4, [1e308, 0.0], 0), (5, [5e-324, 0.0], 0),
            (6, [0.0, -0.0], 0), (7, [1e200, float("inf")], 0), (8, [1e200, 1.1e200], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_dedup(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 8: (3, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7)}


def test_graph_recall_and_large_clusters():
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(3, 32))
    v = np.concatenate([rnd.normal(size=(500, 32)), base[rnd.integers(3, size=400)] + 0.02 * rnd.normal(size=(400, 32))])
    g = E.Graph(E.unit(v[rnd.permutation(len(v))]))
    assert g.audit(0.98) >= E.AUDIT or g.beam >= len(v)
    a, b = g.near(g.vecs, 0.98)
    exact = int((g.vecs @ g.vecs.T >= 0.98).sum())
    assert len(set(zip(a.tolist(), b.tolist()))) >= 0.97 * exact and len(a) <= exact


def test_embedding_query_recall(spark, sf_dir):
    rows = [(r.vec_id, np.array(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    links, _ = exact_links(rows)
    found = sum(r.n_links for r in QUERIES["op8_embedding_near_dedup"](spark, sf_dir).collect())
    assert 0.9 * sum(links.values()) <= found <= sum(links.values())


@pytest.mark.parametrize("text, role, body", [
    ("User: hi", "user", "hi"), ("### Assistant\nfine", "assistant", "fine"), ("<|system|> be kind", "system", "be kind"),
    ("[Human] yes", "user", "yes"), ("**Bot**: ok", "assistant", "ok"), ("no marker: here", "", "no marker: here"),
    ("Userland grows", "", "Userland grows"), ("", "", "")])
def test_markers(text, role, body):
    found, at = T.marker(text)
    assert (found, text[at:].strip()) == (role, body)
    assert T.render(text, "user") == f"<|user|>\n{body}\n<|end|>\n"


def chats(rnd, n, marked=False):
    out = []
    for c in range(n):
        roles = (["system"] if rnd.random() < 0.3 else []) + ["user", "assistant"] * rnd.randrange(1, 5)
        for k, r in enumerate(roles):
            size = {"system": 4, "user": 8, "assistant": 60}[r]
            text = " ".join("abcdefg"[rnd.randrange(7)] * 3 for _ in range(rnd.randrange(size // 2, size * 2)))
            out.append((c, k, r, f"{r.title()}: {text}" if marked else text + ("?" if r == "user" else ".")))
    return out


def chat_frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)


def test_roles_are_recovered(spark):
    rows = chats(random.Random(2), 60)
    got = T.format_conversations(chat_frame(spark, rows), training=F.col("conv") % 4 != 0).collect()
    held = [r for r in got if r.conv_id % 4 == 0]
    assert len(got) == len(rows) and sum(r.role == r.role_pred for r in held) / len(held) >= 0.95
    hidden = T.format_conversations(chat_frame(spark, chats(random.Random(3), 20, marked=True) + [(99, 0, "user", "User: q")]),
                                    training=F.col("conv") != "99").collect()
    assert sum(r.role == r.role_pred for r in hidden) / len(hidden) >= 0.95


def test_blocks_give_the_path_of_the_whole_conversation(spark):
    """One conversation with most rows, cut into many blocks."""
    rnd = random.Random(4)
    rows = [(7, k, ["user", "assistant"][k % 2], " ".join("x" * rnd.randrange(1, 9) for _ in range(rnd.randrange(1, 40)))) for k in range(600)]
    rows += [(c, k, r, t) for c, k, r, t in chats(rnd, 8) if c != 7]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = T.transcript_blocks(chat_frame(spark, rows), "conv_id", "turn", "text", F.col("role"))
        assert blocks.filter("conv = '7'").select("block").distinct().count() > 1
        counts = [tuple(r) for r in T.role_counts(blocks).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    by_conv = {}
    for c, k, r, t in sorted(rows, key=lambda x: x[:2]):
        by_conv.setdefault(c, []).append((r, t))
    plain = {}
    for turns in by_conv.values():
        for k, (r, t) in enumerate(turns):
            steps = [("start", r, "")] if not k else [("step", turns[k - 1][0], r)]
            for key in steps + [(f, r, x) for f, x in zip(T.FEATURES, T.observe(t))]:
                plain[key] = plain.get(key, 0) + 1
    assert {c[:3]: c[3] for c in counts} == plain
    model = T.RoleModel.from_counts(counts)
    got = {(int(r.conv), r.seq): r.role_pred for r in T.decode_transcripts(blocks, model).collect()}
    for c, turns in by_conv.items():
        path = model.decode(model.scores([t for _, t in turns]))
        assert [got[c, k] for k in range(len(turns))] == [model.roles[s] for s in path]


def test_transcript_odd_rows(spark):
    big = 2**62 + 1
    rows = [(1, 0, "user", "hello?"), (1, 0, "user", "hello?"), (1, big, None, None), (None, 0, "user", "a"), (None, None, "assistant", ""),
            (2, None, None, "y " * 100_000), (3, 5, "system", "b"), (3, 5, "user", "b")]
    df = chat_frame(spark, rows).withColumn("block", F.lit(1)).withColumn("pos", F.lit("x"))
    got = T.format_conversations(df).collect()
    assert len(got) == len(rows) and all(r.role_pred for r in got) and big in {r.turn for r in got}
    assert T.format_conversations(df.limit(0)).count() == 0
    none = T.format_conversations(df.withColumn("role", F.lit(None).cast("string"))).collect()
    assert {r.role_pred for r in none} == {None} and all(r.rendered.startswith("<|unknown|>") for r in none)


def test_transcript_returns_every_row(spark):
    rows = [(1, 0, "user", "hello?"), (1, 0, "user", "hello?"), (None, None, "user", "thanks"), (None, None, "user", "thanks"),
            (2, 3, "assistant", "Hi.")]
    df = chat_frame(spark, rows).withColumn("copies", F.monotonically_increasing_id())
    got = T.format_conversations(df).collect()
    assert sorted((str(r.conv_id), str(r.turn), r.role) for r in got) == sorted((str(c), str(t), r) for c, t, r, _ in rows)


def test_chat_query(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # 98 held-out turns instead of 10
    got = QUERIES["op5_chat_formatting"](spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/conversations.parquet").count()
    held = [r for r in got if zlib.crc32(str(r.conv_id).encode()) % 5 == 0]
    assert sum(r.role == r.role_pred for r in held) / len(held) >= 0.9


def test_queries_and_oracle_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)


def stage_rows(spark, sf_dir):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in P.STAGES:
        before = docs
        docs = P.written(stage(spark, docs, sf_dir), name)
        yield name, before, docs


def test_pipeline_stages(spark, sf_dir):
    """Each stage against a plain version on its own input."""
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, before, after in stage_rows(spark, sf_dir):
        old = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
        if name != "best_fit_packing":
            assert after.schema == before.schema
            new = {r.doc_id: r.text for r in after.collect()}
        if name == "language_id":
            assert new == dict(old)  # every document of the test table has a language
        elif name == "line_dedup":
            for (i, t), gone in zip(old, brute.dropped_lines(old)):
                left = "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone)
                assert new.get(i) == (left if left.split() or not gone else None)
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "ngram_jaccard_join":
            assert new == {i: t for i, t in old if brute_first(old)[i] == i}
        elif name == "benchmark_decontamination":
            flagged = brute.decontaminate(old, items)
            assert new == {i: t for (i, t), f in zip(old, flagged) if not f[-1]} and any(f[-1] for f in flagged)
        else:
            check_bins(after.collect(), old, 8192)


def brute_first(docs, _seen={}):
    key = tuple(i for i, _ in docs)
    if key not in _seen:
        _seen[key] = {i: c for i, (_, c) in brute.jaccard(docs).items()}
    return _seen[key]


def test_pipeline_stages_on_odd_rows(make_docs, spark, tmp_path, sf_dir):
    import corpus_pipeline as P
    rnd = random.Random(1)
    text = " ".join(rnd.choice("abcdefgh") + rnd.choice("ab") * rnd.randrange(1, 9) for _ in range(30))
    w = text.split()
    rows = [(1, text), (2, text + " more"), (2, text + " more"), (3, None), (4, ""), (5, "123 456"), (None, " ".join(w[5:9])),
            (6, " ".join(w[20:24]) + "\n\n" + " ".join([*w[:3], "x", *w[4:]])), (7, (" ".join(w[8:14]) + " ") * 9_000)]
    docs = make_docs(rows).withColumn("id", F.lit(1)).withColumn("contaminated", F.lit("x")).withColumn("dropped", F.lit(0))
    for name, stage in P.STAGES:
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0
        out = stage(spark, docs, sf_dir)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = P.written(out, f"odd-{name}") if name != "best_fit_packing" else docs
    left = {r.doc_id: r.text for r in docs.collect()}
    assert set(left) == {1, 6, 7, None} and left[6] == " ".join(w[20:24]) + "\n"


def test_near_copy_stage_keeps_one_of_each_group(make_docs, spark, sf_dir):
    import corpus_pipeline as P
    rnd = random.Random(2)
    w = [f"w{rnd.randrange(900)}" for _ in range(60)]

    def near(k):
        return " ".join([*w[:k], f"x{k}", *w[k + 1:]])
    groups = [[(1, near(50)), (1, near(51)), (5, near(52)), (None, near(53)), (None, near(54))],
              [(None, "a b c d e f"), (None, "a b c d e f")],
              [(9, " ".join(w[::-1])), (9, " ".join(w[::-1])), (9, " ".join(w[::-1])), (8, " ".join([*w[::-1], "y"]))],
              [(20, "alone in its group with some words")]]
    rows = [r for g in groups for r in g] + [(30, None), (30, None), (31, "")]
    docs = make_docs(rows).withColumn("id", F.lit("x")).withColumn("tkey", F.lit(1)).withColumn("copies", F.lit(None).cast("int"))
    out = P.near_copy_stage(spark, docs, sf_dir)
    assert out.columns == docs.columns
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert len([x for x in left if x[0] == 1]) == 1 and sorted(str(i) for i, _ in left) == sorted(["1", "None", "8", "20", "30", "30", "31"])
    assert (None, "a b c d e f") in left


def test_pipeline_run(spark, sf_dir):
    import corpus_pipeline as P
    rows = P.run(spark, sf_dir).collect()
    assert rows and {"doc_id", "piece", "bin_id", "start", "n"} == set(rows[0].asDict())
