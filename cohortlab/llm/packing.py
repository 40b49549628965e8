"""Best-fit packing of documents into bins, with conflicts.

Documents are packed into bins of ``capacity`` units. A bin holds at most one
piece of each source and one of each duplicate cluster. A document larger than
a bin is cut: its full pieces are bins of their own, the rest is packed.

Items are dealt by a hash into shards of about ``shard_rows`` items (a copy
number is part of the hash, so that equal rows spread); the number of shards
follows the number of items and each shard is packed on its own. Within one,
items come in descending size (ties by key as text, then piece and copy). Open bins
are kept in order of what is left in them, each with a bitmap of its sources
and one of its clusters. The search starts at the smallest residual that can
hold the item and goes on to the next larger one until a bin without a
conflict is found: the tightest compatible bin, the lower bin number among
equals. If there is none, a bin is opened.

Defined results: a null or negative size counts as 0; items of size 0 are
placed like others; a null source or cluster conflicts with nothing; repeated
rows are items of their own; an empty table has no bins.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

CAPACITY = 8192
SHARD_ROWS = 4096


class Bins:
    """Open bins of one shard, by residual."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []          # ascending, each once
        self.at: dict[int, list[int]] = {}      # residual -> bin numbers, ascending
        self.sources: list[int] = []            # bitmap of each bin
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, start in the bin) of the item; ``source`` and ``cluster``
        are bitmaps with one bit, or 0."""
        i = bisect_left(self.residuals, size)
        while i < len(self.residuals):
            left = self.residuals[i]
            for b in self.at[left]:
                if not (self.sources[b] & source or self.clusters[b] & cluster):
                    self._move(b, i, left, left - size)
                    self.sources[b] |= source
                    self.clusters[b] |= cluster
                    return b, self.capacity - left
            i += 1
        b = len(self.sources)
        self.sources.append(source)
        self.clusters.append(cluster)
        self._add(b, self.capacity - size)
        return b, 0

    def _add(self, b: int, left: int) -> None:
        if left not in self.at:
            self.at[left] = []
            insort(self.residuals, left)
        insort(self.at[left], b)

    def _move(self, b: int, i: int, old: int, new: int) -> None:
        if new == old:
            return
        self.at[old].remove(b)
        if not self.at[old]:
            del self.at[old]
            del self.residuals[i]
        self._add(b, new)


def bit_of(values: list) -> list[int]:
    """A one-bit bitmap per value; values that occur once and nulls get 0."""
    seen: dict = {}
    for v in values:
        if v is not None:
            seen[v] = seen.get(v, 0) + 1
    index = {v: i for i, v in enumerate(v for v, n in seen.items() if n > 1)}
    return [1 << index[v] if v in index else 0 for v in values]


def pack_shard(items: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """(bin, start) of each (size, source, cluster), in the order given."""
    bins = Bins(capacity)
    sources, clusters = bit_of([x[1] for x in items]), bit_of([x[2] for x in items])
    return [bins.place(x[0], s, c) for x, s, c in zip(items, sources, clusters, strict=True)]


def packing_items(docs: DataFrame, key: str, size: Column, source: Column, cluster: Column,
                  capacity: int) -> DataFrame:
    """(id, size, source, cluster, copy, piece, n): one row per piece."""
    n = F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0))
    rows = docs.select(F.col(key).alias("id"), n.alias("size"), F.xxhash64(source.cast("string")).alias("s"),
                       source.isNull().alias("no_s"), F.xxhash64(cluster).alias("c"), cluster.isNull().alias("no_c"))
    rows = rows.select("id", "size", F.when(~F.col("no_s"), F.col("s")).alias("source"),
                       F.when(~F.col("no_c"), F.col("c")).alias("cluster"))
    # equal rows are counted before the shuffle and told apart by a copy number after it
    rows = (rows.groupBy("id", "size", "source", "cluster").agg(F.count("*").alias("copies"))
            .select("id", "size", "source", "cluster", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")))
    full = F.floor(F.when(F.col("size") > 0, F.col("size") - 1).otherwise(F.lit(0)) / capacity)
    return (rows.select("*", F.explode(F.sequence(F.lit(0), full)).alias("piece"))
            .select("id", "size", "source", "cluster", "copy", "piece",
                    F.least(F.col("size") - F.col("piece") * capacity, F.lit(capacity)).alias("n")))


def text_cluster(text: str = "text") -> Column:
    """The cluster of exact copies; a null text has none."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def best_fit_pack(docs: DataFrame, *, size: Column, source: Column, cluster: Column, key: str = "doc_id",
                  capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: key, piece, bin_id, start, n. Runs one job that
    writes the items (no texts) to the shared checkpoint folder."""
    items = written(packing_items(docs, key, size, source, cluster, capacity), "items")
    full = items.filter(F.col("n") == capacity)
    rest = items.filter(F.col("n") < capacity)
    shards = max(1, math.ceil(rest.count() / shard_rows))
    kind = "id string, piece bigint, bin_id string, start bigint, n bigint"

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "id", "piece", "copy"], ascending=[False, True, True, True], na_position="last")
        missing = pdf[["source", "cluster"]].isna()
        cols = [[None if m else int(v) for v, m in zip(pdf[c], missing[c], strict=True)] for c in ("source", "cluster")]
        got = pack_shard(list(zip(pdf["n"].tolist(), *cols, strict=True)), capacity)
        shard = int(pdf["shard"].iloc[0])
        return pd.DataFrame({"id": pdf["id"], "piece": pdf["piece"], "bin_id": [f"{shard}-{b}" for b, _ in got],
                             "start": [s for _, s in got], "n": pdf["n"]})

    shard = F.pmod(F.xxhash64("id", "piece", "copy", "n"), F.lit(shards))
    # pandas would make doubles of numbers with nulls: these columns travel as text
    packed = (rest.select(F.col("id").cast("string"), "piece", "copy", "n", F.col("source").cast("string"),
                          F.col("cluster").cast("string"), shard.alias("shard"))
              .groupBy("shard").applyInPandas(pack, kind).withColumn("id", F.col("id").cast(items.schema["id"].dataType)))
    own = full.select("id", "piece", F.concat_ws("-", F.lit("full"), F.coalesce(F.col("id").cast("string"), F.lit("null")),
                                                 F.col("copy").cast("string"), F.col("piece").cast("string"),
                                                 F.col("size").cast("string"), F.hex(F.xxhash64("source", "cluster"))).alias("bin_id"),
                      F.lit(0).cast("bigint").alias("start"), F.col("n"))
    return packed.unionByName(own).withColumnRenamed("id", key)
