"""Conversation structure repair against enumeration and a plain programme."""
import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from cohortlab.llm import structure_repair as R
from cohortlab.llm.catalog import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")
OUT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def spaced(x):
    return " " if x is None else str(x)


def damage(rows):
    out = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{spaced(c)}:{spaced(t)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(c, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults(rows):
    """Faults of one conversation's (role, text) rows."""
    seen, out = set(), []
    for r, t in rows:
        w = re.sub(r"[\x20\x09-\x0D]", "", t)
        out.append("blank" if not w else "duplicate" if (r, t) in seen else "" if w[-1] in ".!?" else "truncated")
        seen.add((r, t))
    return out


def options(role, text, fault):
    """(edit, cost, kept row or None)"""
    yield "D", 4, None
    if fault in ("", "truncated"):
        more = 3 if fault else 0
        yield "K", more, (role, text)
        yield "R", 3 + more, ("user", text)
        yield "R", 3 + more, ("assistant", text)


def enumerated(rows):
    """(cost, audit, repaired rows) by trying everything."""
    gaps = [[("I", 3, (r, "")) for r in g] for g in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user"))]
    f = faults(rows)
    best = None
    for pick in itertools.product(*[list(options(r, t, x)) for (r, t), x in zip(rows, f, strict=True)]):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            steps = list(put[0])
            for p, g in zip(pick, put[1:], strict=True):
                steps += [p, *g]
            kept = [s[2] for s in steps if s[2]]
            if all(r for r, _ in kept) and GOOD.fullmatch("".join(r[0] for r, _ in kept)):
                now = (sum(s[1] for s in steps), "".join(s[0] for s in steps), kept)
                best = min(best, now) if best else now
    return best


def programmed(rows):
    """The same for longer conversations: cheapest, then least, suffix from each state."""
    f, go = faults(rows), {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(None)
    def best(i, q, puts):
        found = []
        if puts < 2:
            for x, name in (("u", "user"), ("a", "assistant")):
                if x in go[q]:
                    c, a, k = best(i, go[q][x], puts + 1)
                    found.append((c + 3, "I" + a, ((name, ""), *k)))
        if i == len(rows):
            if q in ("", "a"):
                found.append((0, "", ()))
        else:
            for e, cost, kept in options(*rows[i], f[i]):
                if kept is None or kept[0][:1] in go[q]:
                    c, a, k = best(i + 1, q if kept is None else go[q][kept[0][:1]], 0)
                    found.append((c + cost, e + a, k if kept is None else (kept, *k)))
        return min(found) if found else (10**9, "", ())

    for i in range(len(rows), 0, -1):     # keeps the recursion shallow
        for q in go:
            best(i, q, 0)
    return best(0, "", 0)


def report(rows, solve=programmed):
    """The whole report of damaged rows, given every conversation's id."""
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in damage(rows) if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        pairs = [r[2:] for r in own]
        f, turns = faults(pairs), [r[1] for r in own if r[1] is not None]
        cost, audit, kept = solve(pairs)
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("blank"), f.count("duplicate"),
                  f.count("truncated"), bad, cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def got(df):
    assert df.columns == OUT
    rows = df.collect()
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.fixture
def many_blocks(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", old)


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "usher", "", None, "User"]
TEXTS = ["One.", "Two?", "three", "", " \t", None, "Four!\n", "five é", "Six. "]


def test_small_conversations_equal_enumeration(spark):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(ROLES), rnd.choice(TEXTS)) for c in range(90) for t in range(rnd.randrange(1, 4))]
    # damage can repeat a turn: four turns are too many to enumerate quickly
    rows = [r for r in rows if sum(x[0] == r[0] for x in damage(rows)) <= 3]
    want = report(rows, enumerated)
    assert want == report(rows)
    assert got(R.structure_report(spark.createDataFrame(rows, SCHEMA).repartition(3))) == want


def test_equals_plain_programme(spark, many_blocks):
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(ROLES[:6]), rnd.choice(TEXTS)) for c in range(40) for t in rnd.sample(range(12), rnd.randrange(1, 12))]
    rows += [(100, t, ("user", "assistant")[t % 2], f"Text {t}.") for t in range(400)]       # spans blocks
    rows += [(101, t, "user", "again.") for t in range(300)] + [(102, 1, "user", "same.")] * 50
    rows += [(None, t, rnd.choice(ROLES), rnd.choice(TEXTS)) for t in range(30)]
    rows += [(103, None, rnd.choice(ROLES), x) for x in TEXTS] + [(104, 5, r, "Tie.") for r in ROLES] + [(105, None, None, None)]
    df = (spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("copies", F.lit("x")).withColumn("conv", F.lit(1))
          .withColumn("block", F.lit(None)).withColumn("digest", F.lit(0)))
    assert got(R.structure_report(df)) == report(rows)


def test_repaired_turns_give_the_hash(spark, many_blocks):
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(ROLES[:5]), rnd.choice(TEXTS)) for c in range(20) for t in range(9)]
    df = R.damaged(spark.createDataFrame(rows, SCHEMA))
    lines: dict = {}
    for r in sorted(R.repaired_turns(df, copies=F.col("copies")).collect()):
        lines.setdefault(r[0], []).append(f"{r.role}:{r.text}")
        assert r.place == len(lines[r[0]])
    want = report(rows)
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_dropped_and_empty(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [(gone, 1, "user", "Hi."), (gone, 1, "user", "Hi again.")]
    assert got(R.structure_report(spark.createDataFrame(rows, SCHEMA))) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert R.structure_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_powers_equal_single_steps():
    rnd = random.Random(2)
    for s in ["s0", "u0", "u1", "a0", "a1", "x0", R.GONE]:
        v = R.END
        for n in range(1, 40):
            v = R.apply(R.power(s, 0), v)
            assert R.advance(s, n, R.END) == v == R.apply(R.matrix([(s, n)]), R.END)
    runs = [(rnd.choice(["u0", "a1", "x0", R.GONE]), rnd.randrange(1, 9)) for _ in range(30)]
    v = R.END
    for s, n in reversed(runs):
        v = R.advance(s, n, v)
    assert v == R.apply(R.matrix(R.runs_of(runs)), R.END)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_structure_repair"](spark, sf_dir)) == report(rows)
