"""N-gram Jaccard join with a token-group matrix.

Documents are sets of distinct word shingles; two link when 100 * |A & B| >=
percent * |A | B|. The result is exact: components of all links.

1. Classes. Documents with equal sets are one class (a 64-bit hash of the set).
2. Shared shingles. A member of a link shares at least percent/100 of its own
   shingles with another class. Each map task counts what is shared inside its
   slice and sends every other shingle once (4 bytes, packed by hash bucket;
   a shingle that is frequent in the slice is sent as one marker), the buckets
   count what is shared across slices. Classes below the bound cannot link and
   are done. (Counts can only be too high, never too low, so none is lost.)
3. Rarity. The document frequencies among the remaining classes order their
   shingles. The prefix of a class is its n - ceil(percent/100 n) + 1 rarest;
   classes that link share a prefix shingle. One that no other class holds
   finds nothing, so classes whose prefix consists of such are done too.
4. Groups. Similar classes are brought together by min-hash: in each bucket
   all compare with one leader, the class whose shingles are most frequent.
   Verified links give components, and components in blocks of about
   ``group_size`` are the groups.
5. Matrix. (shingle, group) for the prefix shingles of the members. A class
   queries the groups of components after its own: those that hold one of its
   prefix shingles, unless the sizes and the place of that shingle among the
   class's, by rarity, rule a link out. A group is opened only if the union of its members'
   shingles holds enough of the query's; inside,
   members are compared exactly up to the first link (a group is connected
   already). Groups with many queries are split by salt.

No step forms all pairs of a bucket, and no size is capped: hot shingles only
count, hot buckets are stars, hot groups are salted.

Components need no more links than those that connect them. ``jaccard_links``
and ``jaccard_link_counts`` give all links: there a class also queries the
groups of its own component, and an opened group returns every member that
links. Links between classes grow with the square of a group of different
texts; copies are one class and only weigh the counts.

Defined results: null and empty texts have no shingles, link with nothing and
are their own component; a text with fewer than ``shingle`` words is one
shingle, the whole; repeated rows are one class; a null id never names a
component unless all its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import connected_components
from .line_dedup import text_key
from .scratch import small_side, written

SHINGLE = 5
PERCENT = 80
GROUP_SIZE = 32
QUERIES_PER_TASK = 512
SLICE_BYTES = 1 << 20
_TABLE = K.ascii_table("nonspace", lower=True)
_EMPTY = np.zeros(0, dtype=np.uint64)


def shingle_sets(raw: np.ndarray, off: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash) of a slice: sorted, each pair once."""
    w = K.Words(raw, off, _TABLE)
    count = w.count()
    h = K.windows(w.hash, shingle)
    at = np.flatnonzero(w.row[: len(h)] == w.row[shingle - 1: shingle - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
    rows, hashes = w.row[at], h[at]
    short = np.flatnonzero((count > 0) & (count < shingle))
    if len(short):
        rows = np.concatenate([rows, short])
        hashes = np.concatenate([hashes, [K.sequence_hash(w.hash[w.first[r]: w.first[r + 1]]) for r in short.tolist()]])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    once = np.ones(len(rows), dtype=bool)
    once[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[once], hashes[once]


def set_keys(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(class key, size) of each row's set; an empty set has key 0."""
    size = np.bincount(rows, minlength=n_rows)
    key = np.zeros(n_rows, dtype=np.uint64)
    full = np.flatnonzero(size)
    if len(full):
        start = np.concatenate([[0], np.cumsum(size)[:-1]])[full]
        # a sum over the set, of values mixed once more
        total = np.add.reduceat(K.mix(hashes ^ K._P), start)
        key[full] = K.mix(total + size[full].astype(np.uint64)) | K.U(1)
    return key, size


def _classes(src: DataFrame, shingle: int) -> DataFrame:
    """(id, tkey, cls, n) of (id, tkey, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(2))
            cls, size = [_EMPTY], [np.zeros(0, dtype=np.int64)]
            for lo, hi in K.slices(off, SLICE_BYTES):
                k, n = set_keys(*shingle_sets(raw, off[lo: hi + 1], shingle), hi - lo)
                cls.append(k)
                size.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(K.signed(np.concatenate(cls))),
                                              pa.array(np.concatenate(size))], names=["id", "tkey", "cls", "n"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, tkey bigint, cls bigint, n bigint")


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _exchange_rows(src: DataFrame, shingle: int, buckets: int) -> DataFrame:
    """Blobs for the buckets: ``tok`` (32 bits of the shingles no other class
    of the slice has, and markers), ``cls`` with ``per`` (how many of ``tok``
    each class has, class 0 for markers), ``own``/``seen`` (classes and how many of
    their shingles another class of the slice has)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for b in batches:
            raw, off = K.utf8_buffers(b.column(0))
            for lo, hi in K.slices(off, SLICE_BYTES):
                rows, hashes = shingle_sets(raw, off[lo: hi + 1], shingle)
                key, _ = set_keys(rows, hashes, hi - lo)
                _, one = np.unique(key, return_index=True)  # one row for each class
                pick = np.zeros(hi - lo, dtype=bool)
                pick[one] = True
                keep = pick[rows]
                rows, hashes = rows[keep], hashes[keep]
                if not len(rows):
                    continue
                order = np.argsort(hashes, kind="stable")
                sorted_h = hashes[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = sorted_h[1:] != sorted_h[:-1]
                start = np.flatnonzero(new)
                times = np.diff(np.append(start, len(order)))
                shared = np.zeros(len(order), dtype=bool)
                shared[order] = np.repeat(times > 1, times)
                seen = np.bincount(rows[shared], minlength=hi - lo)
                own = np.flatnonzero(seen)
                markers = sorted_h[start[times > 1]]
                # entries in the order (bucket, class): class 0 are the markers
                tok = np.concatenate([markers, hashes[~shared]])
                cls = np.concatenate([np.zeros(len(markers), dtype=np.uint64), key[rows[~shared]]])
                where = ((tok >> K.U(32)) % K.U(buckets)).astype(np.int64)
                order = np.lexsort((cls, where))
                tok, cls, where = (tok[order] & K.U(0xFFFFFFFF)).astype(np.uint32), cls[order], where[order]
                cuts = np.flatnonzero(np.diff(where, prepend=-1, append=buckets))
                out: list[tuple] = []
                for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    change = np.flatnonzero(np.diff(cls[x:y], prepend=~cls[x]))
                    per = np.diff(np.append(change, y - x)).astype(np.uint32)
                    out.append((int(where[x]), _pack(tok[x:y]), _pack(cls[x:y][change]), _pack(per), b"", b""))
                if len(own):
                    turn += 1
                    out.append(((lo + turn * 7919 + int(key[own[0]] % K.U(buckets))) % buckets, b"", b"", b"",
                                _pack(key[own]), _pack(seen[own].astype(np.uint32))))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                    names=["bucket", "tok", "cls", "per", "own", "seen"])

    return src.select("text").mapInArrow(
        run, "bucket int, tok binary, cls binary, per binary, own binary, seen binary")


def _gather(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)


def _total(cls: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(cls, return_inverse=True)
    return u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.uint32)


def shared_counts(src: DataFrame, shingle: int, buckets: int) -> DataFrame:
    """(cls, shared): at least the number of the class's shingles that
    another class has too; classes without any have no row."""
    parts = max(1, buckets // 16)

    def count(table: pa.Table) -> pa.Table:
        tok, cls = _gather(table, "tok", np.uint32), _gather(table, "cls", np.uint64)
        cls = np.repeat(cls, _gather(table, "per", np.uint32))
        order = np.argsort(tok, kind="stable")
        st, sc = tok[order], cls[order]
        new = np.ones(len(st), dtype=bool)
        new[1:] = st[1:] != st[:-1]
        start = np.flatnonzero(new)
        found, n = [_gather(table, "own", np.uint64)], [_gather(table, "seen", np.uint32)]
        if len(start):
            two = np.minimum.reduceat(sc, start) != np.maximum.reduceat(sc, start)
            group = np.cumsum(new) - 1
            hit = two[group] & (sc != 0)
            # a class that several slices hold counts once per shingle
            order = np.lexsort((sc[hit], group[hit]))
            g, c = group[hit][order], sc[hit][order]
            once = np.ones(len(g), dtype=bool)
            once[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
            found.append(c[once])
            n.append(np.ones(int(once.sum()), dtype=np.uint32))
        c, n = _total(np.concatenate(found), np.concatenate(n))
        part = (c >> K.U(20)) % K.U(parts)
        rows = [(p, _pack(c[part == p]), _pack(n[part == p])) for p in np.unique(part).tolist()]
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "cls": pa.array([r[1] for r in rows], pa.binary()),
                         "n": pa.array([r[2] for r in rows], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        c, n = _total(_gather(table, "cls", np.uint64), _gather(table, "n", np.uint32))
        return pa.table({"cls": K.signed(c), "shared": n.astype(np.int64)})

    return (_exchange_rows(src, shingle, buckets)
            .groupBy("bucket").applyInArrow(count, "part int, cls binary, n binary")
            .groupBy("part").applyInArrow(add, "cls bigint, shared bigint"))


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(cls, n, toks sorted) of (text); one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = K.utf8_buffers(b.column(0))
            for lo, hi in K.slices(off, SLICE_BYTES):
                rows, hashes = shingle_sets(raw, off[lo: hi + 1], shingle)
                key, size = set_keys(rows, hashes, hi - lo)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                # by value as signed numbers, as Spark sorts them
                toks = K.signed(hashes)
                toks = toks[np.lexsort((toks, rows))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(key)), pa.array(size), pa.ListArray.from_arrays(pa.array(ends), pa.array(toks))],
                    names=["cls", "n", "toks"])

    return texts.mapInArrow(run, "cls bigint, n bigint, toks array<bigint>")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets."""
    x, y = len(a), len(b)
    if 100 * min(x, y) < percent * max(x, y):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (x + y - both)


def _linked_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """The rows (u, v) of (u, v, a, b) whose sets link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                p = b.slice(at, 256)
                sets = [[x.values.to_numpy() for x in p.column(i)] for i in (2, 3)]
                ok = [linked(x, y, percent) for x, y in zip(*sets, strict=True)]
                yield p.filter(pa.array(ok, pa.bool_())).select(["u", "v"])

    return pairs.select("u", "v", "a", "b").mapInArrow(run, "u bigint, v bigint")


def _ranked(sets: DataFrame, percent: int) -> DataFrame:
    """(cls, n, common, central, m1, m2, prefix): the classes whose prefix
    holds a shingle of another class; ``prefix`` those shingles; ``common``
    how many of its shingles another class has; ``central`` the mean log
    frequency; m1, m2 two min-hashes."""
    tokens = sets.select("cls", F.explode("toks").alias("tok"))
    freq = tokens.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1")
    known = (tokens.join(freq, "tok").groupBy("cls")
             .agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("known"), F.sum(F.log("df")).alias("logs"),
                  F.min("tok").alias("m1"), F.min(F.xxhash64("tok")).alias("m2")))
    rows = sets.select("cls", "n").join(known, "cls")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    left = prefix - (F.col("n") - F.size("known"))
    return (rows.filter(left > 0)
            .select("cls", "n", F.size("known").alias("common"), (F.col("logs") / F.col("n")).alias("central"), "m1", "m2",
                    F.transform(F.slice("known", F.lit(1), left.cast("int")), lambda x: x["tok"]).alias("prefix")))


def _leader_links(ranked: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links of each class with the leader of its min-hash buckets."""
    both = None
    for m in ("m1", "m2"):
        lead = ranked.groupBy(m).agg(F.max(F.struct("central", "cls")).alias("x"), F.count("*").alias("k")).filter("k > 1")
        p = (ranked.join(lead, m).select(F.col("cls").alias("u"), F.col("x.cls").alias("v")).filter("u != v"))
        both = p if both is None else both.unionByName(p)
    a = sets.select(F.col("cls").alias("u"), F.col("toks").alias("a"))
    b = sets.select(F.col("cls").alias("v"), F.col("toks").alias("b"))
    return _linked_pairs(both.distinct().join(a, "u").join(b, "v"), percent)


def _opened(percent: int, every: bool):
    """Cogroup of one group's members and its queries: the first link of each
    query with the group, or every one, if the bound lets it be opened. In a
    group of its own component a query returns the members after itself."""
    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if len(members) and len(queries):
            inside = list(zip(members["cls"].tolist(), members["toks"].tolist(), strict=True))
            union = np.unique(np.concatenate([t for _, t in inside]))
            for q, toks, own in zip(queries["q"].tolist(), queries["qtoks"].tolist(), queries["own"].tolist(), strict=True):
                if 100 * int((union[np.minimum(np.searchsorted(union, toks), len(union) - 1)] == toks).sum()) \
                        < percent * len(toks):
                    continue
                hits = ((q, c) for c, t in inside if (c > q or not own) and linked(toks, t, percent))
                found += hits if every else islice(hits, 1)
        return pd.DataFrame({"u": pd.Series([f[0] for f in found], dtype="int64"),
                             "v": pd.Series([f[1] for f in found], dtype="int64")})
    return run


def _class_links(sets: DataFrame, percent: int, group_size: int, every: bool) -> DataFrame:
    """Links (u, v) of classes, each once: all of them if ``every``, or
    otherwise enough to connect the components."""
    ranked = written(_ranked(sets, percent), "ranked")
    near = written(_leader_links(ranked, sets, percent), "leader-links")
    comp = connected_components(near)
    blocks = comp.groupBy("root").agg(F.ceil(F.count("*") / F.lit(group_size)).alias("blocks"))
    blocked = comp.join(blocks, "root")
    placed = written(ranked.join(blocked.withColumnRenamed("node", "cls"), "cls", "left")
                     .select("cls", "n", "common", "prefix", F.coalesce("root", "cls").alias("comp"),
                             F.pmod(F.xxhash64("cls"), F.coalesce("blocks", F.lit(1))).alias("block")), "groups")
    # ``rest``: how many shingles of the class are not rarer than this one and held by another class
    entries = (placed.select("cls", "n", "common", "comp", "block", F.posexplode("prefix").alias("at", "tok"))
               .withColumn("rest", F.col("common") - F.col("at")))
    matrix = entries.groupBy("tok", F.col("comp").alias("gcomp"), F.col("block").alias("gblock")) \
        .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("reach"))
    query = entries.select("tok", "cls", "n", "rest", "comp")
    # if this is the rarest shingle that the two share, they share ``both`` at most and unite ``union`` at least
    both = F.least("rest", "reach")
    union = F.col("n") + F.greatest(F.col("least"), both) - both
    asked = (query.join(matrix, "tok").filter("comp <= gcomp" if every else "comp < gcomp").filter(both * 100 >= union * percent)
             .filter((F.col("most") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("least") * percent))
             .select(F.col("cls").alias("q"), (F.col("comp") == F.col("gcomp")).alias("own"), "gcomp", "gblock").distinct())
    asked = written(asked, "asked")
    salts = asked.groupBy("gcomp", "gblock").agg(F.ceil(F.count("*") / F.lit(QUERIES_PER_TASK)).alias("salts"))
    members = (placed.select("cls", F.col("comp").alias("gcomp"), F.col("block").alias("gblock"))
               .join(salts, ["gcomp", "gblock"]).join(sets.select("cls", "toks"), "cls")
               .select("gcomp", "gblock", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "cls", "toks"))
    queries = (asked.join(salts, ["gcomp", "gblock"])
               .join(sets.select(F.col("cls").alias("q"), F.col("toks").alias("qtoks")), "q")
               .select("gcomp", "gblock", F.pmod(F.xxhash64("q"), F.col("salts")).alias("salt"), "q", "own", "qtoks"))
    group = ["gcomp", "gblock", "salt"]
    more = members.groupBy(*group).cogroup(queries.groupBy(*group)).applyInPandas(_opened(percent, every), "u bigint, v bigint")
    # the links with leaders are among all links
    return more.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")) if every else near.unionByName(more)


def _classes_and_sets(docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The class of each row, and the sets of the classes that can link."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.select(F.col(key).alias("id"), text_key(text).alias("tkey"), F.col(text).alias("text"))
    classes = written(_classes(src, shingle), "classes")
    shared = shared_counts(src.select("text"), shingle, buckets)
    members = classes.filter("n > 0").groupBy("cls").agg(F.max("n").alias("n"), F.min(F.struct("tkey", "id")).alias("one"))
    live = written(members.join(shared, "cls").filter(F.col("shared") * 100 >= F.col("n") * percent)
                   .select("cls", F.col("one.tkey").alias("ltkey"), F.col("one.id").alias("lid")), "live")
    side = small_side(live)
    texts = src.join(side, src.id.eqNullSafe(F.col("lid")) & (src.tkey == F.col("ltkey"))).select("text")
    return classes, written(_sets(texts, shingle).dropDuplicates(["cls"]), "sets")


def _component_rows(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, tkey, cls, root, n_shingles, component_id) of each row."""
    roots = written(connected_components(links).withColumnRenamed("node", "cls"), "roots")
    rooted = (classes.join(small_side(roots), "cls", "left")
              .select("id", "tkey", "cls", "n", F.coalesce("root", "cls").alias("root")))
    # a table of its own, so that the join can split a large component
    first = written(rooted.filter("n > 0").groupBy("root").agg(F.min("id").alias("first")), "first-ids")
    return (rooted.join(first, "root", "left")
            .select("id", "tkey", "cls", "root", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("id")).alias("component_id")))


def jaccard_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       percent: int = PERCENT, group_size: int = GROUP_SIZE) -> DataFrame:
    """(id, tkey, n_shingles, component_id): one row per row of ``docs``;
    ``component_id`` is the smallest key reachable by links."""
    classes, sets = _classes_and_sets(docs, key, text, shingle, percent)
    return _component_rows(classes, _class_links(sets, percent, group_size, every=False)).drop("cls", "root")


def without_near_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                        percent: int = PERCENT, group_size: int = GROUP_SIZE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    key (nulls last), of several texts under that key the one with the smallest text
    key, of equal ones any one. Texts without words are all kept; all columns
    pass through."""
    classes, sets = _classes_and_sets(docs, key, text, shingle, percent)
    rows = _component_rows(classes, _class_links(sets, percent, group_size, every=False)).filter("n_shingles > 0")
    each = written(rows.groupBy("root", "id", "tkey").agg(F.count("*").alias("copies")), "group-members")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "tkey")
    best = written(each.groupBy("root").agg(F.min(order).alias("best"), F.sum("copies").alias("size")).filter("size > 1"), "group-heads")
    stays = (F.col("last") == F.col("best.last")) & F.col("id").eqNullSafe(F.col("best.id")) & (F.col("tkey") == F.col("best.tkey"))
    marked = written(each.withColumn("last", F.col("id").isNull()).join(best, "root")
                     .select(F.col("id").alias("__nc_id"), F.col("tkey").alias("__nc_key"), stays.alias("__nc_stays"), "copies")
                     .filter("NOT __nc_stays OR copies > 1").drop("copies"), "near-copies")

    def same(side: DataFrame):
        return docs[key].eqNullSafe(side["__nc_id"]) & (text_key(docs[text]) == side["__nc_key"])

    side = small_side(marked)
    kept = docs.join(side, same(side), "left_anti")
    repeated = marked.filter("__nc_stays")
    if repeated.limit(1).count() == 0:
        return kept
    # rows that share key and text: one of them
    side = small_side(repeated)
    one = (docs.join(side, same(side)).select("__nc_id", "__nc_key", F.struct(*(docs[c] for c in docs.columns)).alias("__nc_row"))
           .groupBy("__nc_id", "__nc_key").agg(F.first("__nc_row").alias("__nc_row")).select("__nc_row.*"))
    return kept.unionByName(one)


def jaccard_links(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  percent: int = PERCENT, group_size: int = GROUP_SIZE) -> tuple[DataFrame, DataFrame]:
    """The join itself: (id, tkey, cls, n) with the class of each row (0 for a
    text without words), and every link (u, v) of two classes, u < v, once.
    Rows of one class link with each other, too."""
    classes, sets = _classes_and_sets(docs, key, text, shingle, percent)
    return classes, written(_class_links(sets, percent, group_size, every=True), "links")


def jaccard_link_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                        percent: int = PERCENT, group_size: int = GROUP_SIZE) -> DataFrame:
    """key, n_shingles, component_id, n_links: one row per row of ``docs``;
    ``n_links`` is the number of other rows that it links with."""
    classes, links = jaccard_links(docs, key=key, text=text, shingle=shingle, percent=percent, group_size=group_size)
    copies = written(classes.filter("n > 0").groupBy("cls").agg(F.count("*").alias("copies")), "copies")
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = both.join(copies.withColumnRenamed("cls", "v"), "v").groupBy(F.col("u").alias("cls")).agg(F.sum("copies").alias("others"))
    counts = written(copies.join(others, "cls", "left")
                     .select("cls", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
                     .filter("n_links > 0"), "link-counts")
    return (_component_rows(classes, links).join(small_side(counts), "cls", "left")
            .select(F.col("id").alias(key), "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")))


def jaccard_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id."""
    return (jaccard_components(docs, key=key, text=text, shingle=shingle, percent=percent)
            .select(F.col("id").alias(key), "n_shingles", "component_id"))


#: DuckDB SQL for ``jaccard_report`` over ``documents``.
SQL = rf"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + {SHINGLE} - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE} + 1, 1) + 1)) AS p FROM word WHERE len(w) > 0)),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id
                    GROUP BY x.doc_id, y.doc_id) p
  JOIN size m ON m.doc_id = a JOIN size n ON n.doc_id = b WHERE 100 * c >= {PERCENT} * (m.n + n.n - c)),
reach(id, r) AS (SELECT a, b FROM link UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(g.r, d.doc_id)) AS component_id
FROM documents d LEFT JOIN size z ON d.doc_id = z.doc_id
LEFT JOIN (SELECT id, min(r) AS r FROM reach GROUP BY id) g ON d.doc_id = g.id
"""
