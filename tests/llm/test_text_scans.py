"""Token counts, secret scan, language ID: one row per document, no shuffle."""
import hashlib
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cohortlab.llm import secrets as S
from cohortlab.llm import token_counts as TC
from cohortlab.llm.catalog import QUERIES
from cohortlab.llm.language_id import LanguageModel, grams, identify_language, language_id

from . import brute

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "plain words only"), (4, "plain words only"), (None, "a null key"),
       (5, "x" * 70_000), (6, "word " * 30_000), (7, "a<|endoftext|>b <|endoftext|"), (8, "漢字かな交じり文   zéro"),
       (9, " \u0085 tab\tend"), (10, " " * 66_000), (11, "0" * 70_000 + "\n" + "'ll 're" * 9000)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(JSON)


def expected_counts(tokenizer, text):
    return len((text or "").encode()), len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_token_counts_equal_the_library(make_docs, tokenizer, ranks):
    df = make_docs(ODD).withColumn("n_tokens", F.lit("clash"))
    got = sorted(map(tuple, TC.token_counts(df, JSON, ranks).collect()), key=str)
    want = sorted(((i, *expected_counts(tokenizer, t), expected_counts(tokenizer, t)[1] > 512) for i, t in ODD), key=str)
    assert got == want


def test_resynchronised_count_equals_the_whole(tokenizer):
    c = TC.TokenCounter(TC.read_bytes(JSON), None, chunk_chars=200, overlap_chars=64)
    rnd = random.Random(3)
    for n in range(200):
        letters = rnd.choice(["ab  \n", "é'sß漢 \n", "a", "abc 123'll ", " \n"])
        text = "".join(rnd.choice([rnd.choice(letters), rnd.choice(["<|endoftext|>", "    ", "word ", "'re"])])
                       for _ in range(rnd.randrange(200, 2500))) if n % 9 else letters[0] * 3000
        assert c.count_long(text) == expected_counts(tokenizer, text)[1], text[:80]


def test_token_counts_query(spark, sf_dir, tokenizer):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        b, n = expected_counts(tokenizer, r.text)
        assert got[r.doc_id] == (b, n, n > 512)


SECRETS = [(1, None), (2, ""), (3, "nothing here"), (4, "password=abc12"), (4, "password=abc123"),
           (5, "é Password: 'abcdef token=\"x\" api_key = ABC/DEF+1 APIKEY:=abcdef tokſen=abcdef Key"),
           (6, "AKIA" + "A1" * 8 + " AKIA" + "B" * 15 + " xAKIA" + "9" * 30), (7, "deadbeef" * 3 + " " + "deadbeef" * 2 + "F" + "0a" * 16),
           (8, "secret=" + "0123456789abcdef" * 2 + " é passwd:AKIA" + "Z" * 20), (9, "q8Zt1LxWv0Rb7NcY4kPj2 " * 3),
           (10, "some_long_identifier_name/with/parts CamelCaseIdentifierName 12345678901234567890123 " + "a" * 40),
           (11, "f" * 200_000), (None, "token: zzzzzz")]


def test_secret_scan_base(make_docs, spark):
    df = make_docs(SECRETS).withColumn("spans", F.lit(1)).withColumn("n_hex", F.lit("x"))
    got = S.secret_scan(df, RANKS).collect()
    assert len(got) == len(SECRETS)
    want = {}
    for i, t in SECRETS:
        base = brute.base_secrets(t)
        want.setdefault(i, []).append((sum(b[0] == "assign" for b in base), sum(b[0] == "access" for b in base),
                                       sum(b[0] == "hex" for b in base),
                                       hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()))
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) in want[r.doc_id], r
        own = [s for s in r.spans.split(",") if s and not s.startswith("token:")]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r.base_sha256
    assert S.secret_scan(df.limit(0), RANKS).count() == 0


def test_token_efficiency_finds_random_strings_only():
    import pyarrow as pa
    enc = S.encoding(TC.read_bytes(RANKS))
    rnd = random.Random(5)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    strings = ["".join(rnd.choice(alphabet) for _ in range(32)) for _ in range(50)]
    found = S.scan(pa.array([f"é key {s} end" for s in strings]), enc)
    assert sum((6, 38, "token") in f for f in found) >= 48
    clean = ["d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "internationalization",
             "read_the_configuration_file", "www.example.com/some/path/to/page", "12345678901234567890", "HelloWorldOfManyWords"]
    assert not [f for f in S.scan(pa.array(clean), enc) for s in f if s[2] == "token"]


def test_keys_inside_paths_and_of_letters_are_found():
    import string

    import pyarrow as pa
    enc = S.encoding(TC.read_bytes(RANKS))
    rnd = random.Random(6)
    path = "https/www.example.com/some/long/path/to/the/download/page/of/documents/"
    for alphabet, size in ((string.ascii_letters + string.digits, 20), (string.ascii_letters + string.digits, 32),
                           (string.ascii_letters, 24)):
        keys = ["".join(rnd.choice(alphabet) for _ in range(size)) for _ in range(50)]
        for before, after in ((path, ""), (path, "/index.html"), ("", "")):
            found = S.scan(pa.array([f"é {before}{k}{after} end" for k in keys]), enc)
            assert sum(any(a <= 2 + len(before) and 2 + len(before) + size <= b for a, b, kind in f if kind == "token") for f in found) >= 48
    clean = [path + x for x in ("d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000", "internationalization",
                                "12345678901234567890", "HelloWorldOfManyWords")]
    assert not [f for f in S.scan(pa.array(clean), enc) for s in f if s[2] == "token"]


def test_secret_scan_query(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op9_secret_scan"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute.base_secrets(r.text))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_grams_do_not_cross_words_or_texts():
    def of(texts, size):
        h, owner = grams(texts, (size,))
        return [sorted(h[owner == i].tolist()) for i in range(len(texts))]
    assert of(["ab cd", None, "12 3", "ab", "CD!"], 3)[0] == sorted(of(["ab"], 3)[0] + of(["cd"], 3)[0])
    assert [len(x) for x in of(["ab cd", None, "12 3", "a"], 3)] == [4, 0, 0, 1]
    assert of(["x ab", "ab"], 4)[1] == of(["ab"], 4)[0]


def test_language_id_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op3_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in docs.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def naive_language_id(docs):
    """{doc_id: (best language, its share of the text's n-grams, the second's share)} with plain sets."""
    from collections import Counter

    def found(text):
        out, word = [], ""
        for c in (text or "").lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                w = f"_{word}_"
                out += [w[i:i + k] for k in (3, 4) for i in range(len(w) - k + 1) if not (k == 4 and len(w) == 4)]
                word = ""
        return out
    train = [(t, lang) for i, t, lang in docs if lang is not None and zlib.crc32(str(i).encode()) % 5]
    counts = {lang: Counter() for _, lang in train}
    for t, lang in train:
        counts[lang].update(found(t))
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    share = {lang: {g: n / totals[lang] for g, n in c.items()} for lang, c in counts.items()}
    best: dict = {}
    for c in share.values():
        for g, x in c.items():
            best[g] = max(x, best.get(g, 0))
    sets = {lang: {g for g, x in c.items() if x >= 2e-5 and x >= 0.05 * best[g]} for lang, c in share.items()}
    out = {}
    for i, t, _ in docs:
        g = found(t)
        hits = sorted(((sum(x in s for x in g) / len(g), lang) for lang, s in sets.items()), reverse=True) if g else []
        out[i] = (hits[0][1], hits[0][0], hits[1][0]) if g else ("und", 0.0, -1.0)
    return out


def test_language_id_equals_plain_sets(spark, sf_dir):
    """The filters against exact sets of the same n-grams: the same language
    wherever the two best are apart, the same score up to the false positives."""
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = naive_language_id(docs)
    got = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, sf_dir).collect()}
    assert set(got) == set(want)
    apart = [i for i, w in want.items() if w[1] - w[2] > 0.02]
    assert len(apart) > 0.9 * len(want) and all(got[i].lang_pred == want[i][0] for i in apart)
    assert sorted(abs(got[i].score - want[i][1]) for i in want)[int(0.95 * len(want))] < 0.02


def test_language_id_odd_rows(make_docs, spark):
    rows = [(i, "the cat and the dog went home", "en") for i in range(30)] + \
           [(100 + i, "der hund und die katze gehen heim", "de") for i in range(30)]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "123 456 !?", "de"), (1003, "дом", None), (None, "the dog", "en"),
           (1004, "und die katze " * 20_000, None), (1004, "und die katze " * 20_000, None)]
    df = make_docs(rows + odd).withColumn("score", F.lit("clash")).withColumn("held_out", F.lit(3))
    got = {}
    for r in language_id(df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [got[i][0].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1003][0].lang_pred in ("en", "de") and got[1003][0].score <= 0.1
    assert got[None][0].lang_pred == "en" and got[None][0].held_out is False
    assert [r.lang_pred for r in got[1004]] == ["de", "de"]
    assert language_id(df.limit(0)).count() == 0
    nothing = language_id(make_docs([(1, "no labels at all", None)])).collect()
    assert nothing[0].lang_pred == "und"


def test_more_than_one_mask_word():
    import numpy as np
    rnd = np.random.default_rng(1)
    texts = {f"l{i:02d}": "".join(chr(0x4E00 + int(x)) for x in rnd.integers(i * 50, i * 50 + 40, 400)) for i in range(70)}
    model = LanguageModel.build({k: np.unique(grams([t])[0]) for k, t in texts.items()}, list(texts))
    pred, score = model.predict(list(texts.values()))
    assert pred == list(texts) and score.min() > 0.9


def test_identify_keeps_columns(make_docs, spark):
    df = make_docs([(1, "abc"), (2, None)]).withColumn("__t", F.col("text"))
    out = identify_language(df, LanguageModel.build({}, []), keep=df.columns, text="__t")
    assert out.columns == [*df.columns, "lang_pred", "score"] and out.count() == 2
