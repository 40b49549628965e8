"""Importance resampling against a plain version."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlab.llm import resampling as R

from . import brute

ITEMS = "item_id long, text string"


def features(text, low, high):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower_az(text))
    return w, [" ".join(w[i:i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def plain(docs, items, low, high, buckets, min_words, percent):
    def count(texts):
        return Counter(zlib.crc32(x.encode()) % buckets for t in texts for x in features(t, low, high)[1])
    s, t = count(x for _, x in docs), count(x for _, x in items)
    ns, nt = sum(s.values()), sum(t.values())
    rows = []
    for i, x in docs:
        w, f = features(x, low, high)
        g = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
             for b in (zlib.crc32(y.encode()) % buckets for y in f)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, score, len(w)))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = [(*r[:4], k + 1) if k < len(able) * percent // 100 else (*r[:4], None) for k, r in enumerate(able)]
    return sorted(rank + [(*r[:4], None) for r in rows if r[4] < min_words], key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("low,high,buckets,percent", [(1, 1, 97, 30), (1, 2, 50, 60), (2, 3, 70_000, 100)])
def test_equals_plain_version(make_docs, spark, monkeypatch, low, high, buckets, percent):
    rnd = random.Random(high)
    word = ["alpha", "Beta", "GAMMA", "d3", "\u00e9t\u00e9", "\u00c9", "x", "\u4e2d\u6587"]

    def text(n):
        return "".join(rnd.choice(word) + rnd.choice([" ", "  ", ", ", "-", "\n", "\x00"]) for _ in range(n))
    docs = [(i, text(rnd.randrange(0, 40))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "?! "), (None, text(30)), (None, None), (7, text(30)), (8, docs[8][1]),
             (8, docs[8][1]), (103, text(500)), (104, "y" * 300)]
    items = [(i, text(12)) for i in range(8)] + [(None, "alpha d3"), (9, None), (9, "")]
    df = make_docs(docs).withColumn("rank", F.lit("x")).withColumn("id", F.lit(1)).withColumn("score", F.lit(None))
    monkeypatch.setattr(R, "PIECE", 64)
    out = R.importance_resample(df, spark.createDataFrame(items, ITEMS), low=low, high=high, buckets=buckets, min_words=10,
                                percent=percent)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(out) == plain(docs, items, low, high, buckets, 10, percent)


def test_empty_tables(make_docs, spark):
    docs, none = [(1, "a b c"), (2, None)], spark.createDataFrame([], ITEMS)
    out = R.importance_resample(make_docs(docs), none, min_words=1, percent=100)
    assert got(out) == plain(docs, [], 1, 1, R.BUCKETS, 1, 100)
    assert R.importance_resample(make_docs(docs).limit(0), none).count() == 0


def test_many_equal_rows_are_ranked_once_each(make_docs, spark):
    docs = [(5, "one two three")] * 300 + [(i, f"one word{i} here") for i in range(20)]
    rows = got(R.importance_resample(make_docs(docs, 8), spark.createDataFrame([(1, "one")], ITEMS), min_words=3, percent=50))
    assert rows == plain(docs, [(1, "one")], 1, 1, R.BUCKETS, 3, 50)
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, 161))


def test_pieces_end_between_words():
    rnd = random.Random(1)
    for _ in range(200):
        t = "".join(rnd.choice("ab \u00e9-Z9") for _ in range(rnd.randrange(60)))
        parts = list(R.pieces(t, 7))
        assert "".join(parts) == t
        assert [w for p in parts for w in features(p, 1, 1)[0]] == features(t, 1, 1)[0]
