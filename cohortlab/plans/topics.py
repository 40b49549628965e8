"""Online variational LDA without a topic matrix on the driver.

Spark ML's online optimizer (Hoffman et al.) step for step: 5 % of the documents an
iteration, drawn with replacement; the documents' mixtures until they change by
less than 1e-3; topics moved by (1024 + t) ** -0.51; the prior of the mixtures moved,
too. Its k x V topics lie on the driver and in every task; here they are spread.

A topic's weight of a term that no drawn document has so far is the same function
of its first value for all terms, and first values are a hash of (seed, term, topic).
So only what drawn documents added is kept, four-byte numbers, one row a term (``added``); every other
weight is computed where it is needed. What is on the driver: k sums, the prior.

All draws are known before the first iteration. They are written once, in blocks; an
iteration is one job: blocks with the weights of their terms give sums a term, which
move the weights; the rows of the next blocks' terms are sent in the same step. A fit
whose draws times k are at most ``LOCAL_VALUES`` numbers is one task, with the
same steps. Mixtures of all documents are computed against a broadcast of
at most ``BROADCAST_VALUES`` numbers, or else block by block like an iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_scratch, scratch_path

#: Spark ML's defaults.
FRACTION, TAU, KAPPA, GAMMA_SHAPE, CHANGE = 0.05, 1024.0, 0.51, 100.0, 1e-3
#: Numbers (draws' terms x k) of a fit that one task does.
LOCAL_VALUES = 12_000_000
#: Numbers (terms x k, of four bytes) that are broadcast for the mixtures.
BROADCAST_VALUES = 4_000_000
#: Terms of a block, and terms x k of one.
BLOCK_TERMS, BLOCK_VALUES = 32_768, 4_000_000
#: Terms x k of the documents whose mixtures are computed together.
SLICE_VALUES = 400_000
#: Moves along the steps of a document, at most.
MOVES = 300
#: Bytes of added weights that a task holds.
PART_BYTES = 16 << 20
_U = np.uint64
#: Rows of the blocks' table: what a partition holds, documents drawn in iteration t.
_INFO = 0

BLOCKS = "t int, block bigint, sizes binary, terms binary, counts binary, times binary"
_BLOCKS = ["t", "block", "sizes", "terms", "counts", "times"]
#: kind: 0 added weights, 1 sums of a block, 2 terms a block asks for, 3 figures of a block, 4 rows for a block.
ROWS = "part bigint, kind int, block bigint, terms binary, vals binary"
_ROWS = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("terms", pa.binary()), ("vals", pa.binary())])
ADDED, SUMS, ASKED, FIGURES, SENT = range(5)


# numbers

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _seeded(x: np.ndarray, seed: int, of: int) -> np.ndarray:
    """Hash of numbers under a seed and a purpose."""
    with np.errstate(over="ignore"):
        s = _mix(np.array([(seed * 0x9E3779B97F4A7C15 + of * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64))
        return _mix(x.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + s)


def gamma_draws(h: np.ndarray) -> np.ndarray:
    """Gamma(100, 1 / 100) numbers of hashes: Wilson and Hilferty's cube of a normal number."""
    u, v = ((h >> _U(32)).astype(np.float64) + 0.5) / 2.0**32, ((h & _U(0xFFFFFFFF)).astype(np.float64) + 0.5) / 2.0**32
    z = np.sqrt(-2.0 * np.log(u)) * np.cos(2.0 * np.pi * v)
    return (1.0 - 1.0 / (9.0 * GAMMA_SHAPE) + z / (3.0 * np.sqrt(GAMMA_SHAPE))) ** 3


def first_weights(terms: np.ndarray, k: int, seed: int) -> np.ndarray:
    """(terms, k): the topics' weights before the first iteration."""
    with np.errstate(over="ignore"):
        h = _seeded(terms, seed, 1)[:, None] + np.arange(1, k + 1, dtype=np.uint64)[None, :] * _U(0xD1B54A32D192ED03)
        return gamma_draws(_mix(h))


def digamma(x: np.ndarray) -> np.ndarray:
    y = x * (x + 5.0)
    r = (2.0 * x + 5.0) * (1.0 / y + 1.0 / (y + 4.0) + 1.0 / (y + 6.0))
    x = x + 6.0
    i = 1.0 / (x * x)
    return np.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i * (1 / 240 - i / 132)))) - r


def trigamma(x: np.ndarray) -> np.ndarray:
    r = sum(1.0 / (x + j) ** 2 for j in range(10))
    x = x + 10.0
    i = 1.0 / (x * x)
    return r + 1.0 / x + i / 2 + i / x * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30)))


def rate(t: int) -> float:
    return (TAU + t) ** -KAPPA


def times_drawn(numbers: np.ndarray, t: int, seed: int) -> np.ndarray:
    """How often documents are drawn in iteration t: Poisson numbers."""
    u = (_seeded(numbers, seed, 1000 + t) >> _U(11)).astype(np.float64) / 2.0**53
    out, p, below = np.zeros(len(numbers), dtype=np.int32), np.exp(-FRACTION), 0.0
    for j in range(1, 13):
        below += p
        out += u >= below
        p *= FRACTION / j
    return out


def first_mixture(k: int, t: int, seed: int) -> np.ndarray:
    """The mixture that the documents of an iteration start from."""
    return gamma_draws(_seeded(np.arange(k), seed, 100_000 + t))


def _fixed_point(gamma: np.ndarray, b: np.ndarray, c: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(next mixtures, weights of the topics, counts over their terms' weights);
    ``b``: (documents, topics, terms). A factor of a document's topics does not matter,
    so the largest is 1."""
    theta = digamma(gamma)
    theta = np.exp(theta - theta.max(axis=1)[:, None]).astype(np.float32)
    ratio = c / (np.matmul(theta[:, None, :], b)[:, 0, :] + np.float32(1e-30))
    return theta * np.matmul(b, ratio[:, :, None])[:, :, 0].astype(np.float64) + alpha, theta, ratio


class Pool:
    """Documents whose mixtures are computed together; widths are those of the widest."""

    def __init__(self, b, c, gamma, doc):
        self.b, self.c, self.gamma, self.doc, self.total = b, c, gamma, doc, c.sum(axis=1, dtype=np.float64)
        self.cap, self.was, self.rounds = np.full(len(doc), 4.0), np.full(len(doc), np.inf), np.zeros(len(doc), dtype=np.int64)

    def kept(self, keep: np.ndarray, more: Pool | None) -> Pool:
        """The documents of ``keep``, and those of ``more``, which are at least as wide."""
        out = Pool.__new__(Pool)
        for name, x in vars(self).items():
            x = x[keep]
            if more is not None:
                y = getattr(more, name)
                if name in "bc" and x.shape[-1] < y.shape[-1]:
                    x = np.concatenate([x, np.zeros((*x.shape[:-1], y.shape[-1] - x.shape[-1]), dtype=x.dtype)], axis=-1)
                x = np.concatenate([x, y])
            setattr(out, name, x)
        return out


def mixtures(sizes: np.ndarray, rows: np.ndarray, counts: np.ndarray, beta: np.ndarray, alpha: np.ndarray, start: np.ndarray,
             sums: np.ndarray | None = None, times: np.ndarray | None = None) -> np.ndarray:
    """(documents, k) unnormalised mixtures. ``rows`` are places in ``beta``,
    one a term of a document. With ``sums`` (rows of beta, k) what the documents add
    to the weights, over beta, is added to it, ``times`` a document.

    A document is done when a step changes its mixture by less than ``CHANGE`` on
    average. Steps get small slowly while topics are alike (hundreds of them): two steps
    are followed by a move along them (SQUAREM, Varadhan and Roland) from which
    plain steps go on; after a move that made the steps larger there are two plain steps,
    and after ``MOVES`` moves plain steps only. Documents of similar size are computed
    together, and the places of those that are done are taken by others."""
    k, n = len(alpha), len(sizes)
    out = np.tile(start, (n, 1))
    at = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    order = order[int(np.searchsorted(sizes[order], 1)):]
    out[sizes == 0] = alpha
    beta = np.vstack([beta, np.zeros((1, k))]).astype(np.float32)
    none = len(beta) - 1

    def entered(docs: np.ndarray) -> Pool:
        width = int(sizes[docs[-1]])
        inside = np.arange(width) < sizes[docs][:, None]
        place = np.where(inside, at[docs][:, None] + np.arange(width), 0)
        b = np.ascontiguousarray(beta[np.where(inside, rows[place], none)].transpose(0, 2, 1))
        return Pool(b, np.where(inside, counts[place], 0.0).astype(np.float32), out[docs], docs)

    def leave(p: Pool, who: np.ndarray, gamma: np.ndarray) -> None:
        docs = p.doc[who]
        out[docs] = gamma[who]
        if sums is None:
            return
        _, theta, ratio = _fixed_point(gamma[who], p.b[who], p.c[who], alpha)
        inside = np.arange(p.c.shape[1]) < sizes[docs][:, None]
        w = (ratio * times[docs][:, None])[inside].astype(np.float64)
        of = rows[np.repeat(at[docs] - (np.cumsum(sizes[docs]) - sizes[docs]), sizes[docs]) + np.arange(len(w))]
        for j in range(k):
            sums[:, j] += np.bincount(of, weights=w * np.repeat(theta[:, j], sizes[docs]), minlength=len(sums))

    lo, p = 0, None
    while lo < len(order) or (p is not None and len(p.doc)):
        have = 0 if p is None else len(p.doc)
        hi = lo
        while hi < len(order) and (hi == lo and not have or (have + hi + 1 - lo) * int(sizes[order[hi]]) * k <= SLICE_VALUES):
            hi += 1
        if hi > lo:
            more = entered(order[lo:hi])
            p = more if not have else p.kept(np.arange(have), more)
            lo = hi
        size = len(p.doc)
        done = np.zeros(size, dtype=bool)
        while True:
            x1, *_ = _fixed_point(p.gamma, p.b, p.c, alpha)
            r = x1 - p.gamma
            change = np.abs(r).sum(axis=1) / k
            one = ~(change > CHANGE) & ~done
            x2, *_ = _fixed_point(x1, p.b, p.c, alpha)
            v = x2 - x1
            two = ~(np.abs(v).sum(axis=1) / k > CHANGE) & ~done & ~one
            if one.any():
                leave(p, np.flatnonzero(one), x1)
            if two.any():
                leave(p, np.flatnonzero(two), x2)
            done |= one | two
            p.cap = np.where(change > p.was, np.maximum(1.0, p.cap / 4.0), p.cap)
            v -= r
            far = np.sqrt((r * r).sum(axis=1) / np.maximum((v * v).sum(axis=1), 1e-300))
            far = np.where((p.rounds < MOVES) & (change <= p.was), np.clip(far, 1.0, p.cap), 1.0)[:, None]
            p.cap = np.where(far[:, 0] >= p.cap, p.cap * 4.0, p.cap)
            p.was, p.rounds = change, p.rounds + 1
            x = np.maximum(p.gamma + 2.0 * far * r + far * far * v, alpha) - alpha
            p.gamma = alpha + x * (p.total / np.maximum(x.sum(axis=1), 1e-300))[:, None]
            left = size - int(done.sum())
            if not left or (left <= 0.75 * size):
                break
        p = p.kept(~done, None)
    return out


# what moves in an iteration

@dataclass
class Weights:
    """The topics but for what drawn documents added."""
    k: int
    size: int                      # terms
    seed: int
    kept: float                    # share of the first weights that is left
    total: np.ndarray              # sums of the topics' weights
    alpha: np.ndarray              # prior of the mixtures

    def base(self, terms: np.ndarray) -> np.ndarray:
        return self.kept * first_weights(terms, self.k, self.seed) + (1.0 - self.kept) / self.k

    def soft(self, weights: np.ndarray) -> np.ndarray:
        """exp E[log beta], but for the factor of the topics' sums."""
        return np.exp(digamma(weights))

    def beta(self, terms: np.ndarray, have: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """exp E[log beta] of ascending ``terms``; ``rows`` are those of ``have`` (ascending), as ``soft`` gives them."""
        at = np.minimum(np.searchsorted(have, terms), max(0, len(have) - 1))
        known = have[at] == terms if len(have) else np.zeros(len(terms), dtype=bool)
        out = np.empty((len(terms), self.k))
        out[known] = rows[at[known]]
        out[~known] = self.soft(self.base(terms[~known]))
        return out * np.exp(-digamma(self.total))

    def moved(self, t: int, scale: float, sums: np.ndarray, logs: np.ndarray, docs: int) -> Weights:
        """After iteration t: the topics' and the documents' sums of it are given."""
        r = rate(t)
        total = (1.0 - r) * self.total + r * (scale * sums + self.size / self.k)
        a, logs = self.alpha, logs / docs
        gradient = docs * (digamma(a.sum()) - digamma(a) + logs)
        c, q = docs * trigamma(a.sum()), -docs * trigamma(a)
        b = (gradient / q).sum() / (1.0 / c + (1.0 / q).sum())
        step = a + r * -(gradient - b) / q
        return Weights(self.k, self.size, self.seed, self.kept * (1.0 - r), total, step if (step > 0).all() else a)


class Block:
    """Documents that are drawn in one iteration."""

    def __init__(self, row: dict):
        self.sizes, self.times = np.frombuffer(row["sizes"], "<i4").astype(np.int64), np.frombuffer(row["times"], "<i4")
        self.counts = np.frombuffer(row["counts"], "<f8")
        self.terms, self.rows = np.unique(np.frombuffer(row["terms"], "<i4"), return_inverse=True)

    def added(self, t: int, w: Weights, have: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(sums a term, sums of the documents' log mixtures, documents)."""
        beta, sums = w.beta(self.terms, have, rows), np.zeros((len(self.terms) + 1, w.k))
        g = mixtures(self.sizes, self.rows, self.counts, beta, w.alpha, first_mixture(w.k, t, w.seed), sums, self.times)
        logs = (digamma(g) - digamma(g.sum(axis=1))[:, None]) * self.times[:, None]
        return sums[:-1] * beta, logs.sum(axis=0), int(self.times.sum())


def _blocks(iterations: int, seed: int, k: int):
    limit = max(1, min(BLOCK_TERMS, BLOCK_VALUES // k))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = TaskContext.get().partitionId() << 32
        n, docs, size, made = 0, 0, 0, 0
        held: dict[int, list] = {}
        terms_of = np.zeros(iterations + 1, dtype=np.int64)

        def out(t: int) -> pa.RecordBatch:
            parts = list(zip(*held.pop(t)[1], strict=True))
            row = [t, home | made, *(np.concatenate(x).astype(kind).tobytes() for x, kind in zip(parts, ("<i4", "<i4", "<f8", "<i4"), strict=True))]
            return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int32()), pa.array([row[1]], pa.int64()),
                                               *(pa.array([x], pa.binary()) for x in row[2:])], names=_BLOCKS)

        for b in batches:
            length, flat, counts = _known(*b.columns)
            at = np.cumsum(length) - length
            number = home + n + np.arange(b.num_rows)
            n, docs = n + b.num_rows, docs + b.num_rows
            size = max([size, *b.column(0).drop_null().to_pylist()[:1]])
            for t in range(1, iterations + 1):
                times = np.where(length > 0, times_drawn(number, t, seed), 0)
                mine = np.flatnonzero(times)
                cut = np.flatnonzero(np.diff(np.cumsum(length[mine]) // limit, prepend=0)) if len(mine) else mine
                for some in np.split(mine, cut[cut > 0]):
                    if not len(some):
                        continue
                    place = np.repeat(at[some] - (np.cumsum(length[some]) - length[some]), length[some]) + np.arange(int(length[some].sum()))
                    terms_of[t] += len(place)
                    have = held.setdefault(t, [0, []])
                    have[0] += len(place)
                    have[1].append((length[some], flat[place], counts[place], times[some]))
                    if have[0] >= limit:
                        yield out(t)
                        made += 1
        for t in sorted(held):
            yield out(t)
            made += 1
        info = np.concatenate([[docs, size], terms_of[1:]]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([_INFO], pa.int32()), pa.array([home], pa.int64()), pa.array([info], pa.binary()),
                                          *(pa.array([b""], pa.binary()) for _ in range(3))], names=_BLOCKS)

    return draw


def _terms(vectors: DataFrame, col: str = "_tf") -> list:
    """The parts of a column of sparse vectors, or of structs of the same fields
    (of which indices from ``size`` on are not known)."""
    v = F.unwrap_udt(col) if isinstance(vectors.schema[col].dataType, VectorUDT) else F.col(col)
    return [v["size"].alias("_size"), v["indices"].alias("_indices"), v["values"].alias("_values")]


def _known(size: pa.Array, indices: pa.ListArray, values: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known terms a row, the terms, their counts)."""
    length = np.asarray(indices.value_lengths().fill_null(0)).astype(np.int64)
    flat, counts = np.asarray(indices.flatten()), np.asarray(values.flatten())
    row = np.repeat(np.arange(len(length)), length)
    known = flat < np.asarray(size.fill_null(0))[row]
    return (length, flat, counts) if known.all() else (np.bincount(row[known], minlength=len(length)), flat[known], counts[known])


def _first_total(spark: SparkSession, size: int, k: int, seed: int) -> np.ndarray:
    """Sums of the topics' first weights."""
    step = max(1, SLICE_VALUES // k)
    chunk = lambda i: first_weights(np.arange(i * step, min(size, (i + 1) * step)), k, seed).sum(axis=0)
    n = -(-size // step)
    if n <= 4:
        return sum((chunk(i) for i in range(n)), np.zeros(k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for b in batches:
            for i in b.column(0).to_pylist():
                total = total + chunk(i)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    rows = spark.range(0, n, 1, min(n, max(1, spark.sparkContext.defaultParallelism))).mapInArrow(run, "s array<double>").collect()
    return np.sum([r["s"] for r in rows], axis=0)


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_ROWS)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _ROWS, strict=True)], schema=_ROWS)


def _vals(raw: bytes, k: int) -> np.ndarray:
    return np.frombuffer(raw, "<f4").reshape(-1, k)


def _split(terms: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its terms)."""
    home = terms % parts
    o = np.argsort(home, kind="stable")
    cut = np.append(np.flatnonzero(np.diff(home[o], prepend=-1)), len(o))
    for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(home[o[a]]), o[a:z]


def _in_one_task(blocks: DataFrame, w: Weights, iterations: int, scales: float, parts: int) -> DataFrame:
    """Rows of all iterations' result: the added weights, and the moved ``Weights`` as figures."""
    def run(t: pa.Table) -> pa.Table:
        per: dict[int, list[Block]] = {}
        for row in t.sort_by([("t", "ascending"), ("block", "ascending")]).to_pylist():
            per.setdefault(row["t"], []).append(Block(row))
        terms = np.unique(np.concatenate([b.terms for bs in per.values() for b in bs]))
        added, now = np.zeros((len(terms), w.k)), w
        seen = np.zeros(len(terms), dtype=bool)
        for it in sorted(per):
            want = np.unique(np.concatenate([np.searchsorted(terms, b.terms) for b in per[it]]))
            have = want[seen[want]]
            rows = now.soft(now.base(terms[have]) + added[have]).astype("<f4")
            sums, total, logs, docs = np.zeros((len(terms), w.k)), np.zeros(w.k), np.zeros(w.k), 0
            for b in per[it]:
                s, g, n = b.added(it, now, terms[have], rows)
                sums[np.searchsorted(terms, b.terms)] += s.astype("<f4")
                total, logs, docs = total + s.sum(axis=0), logs + g, docs + n
            seen[want] = True
            added = ((1.0 - rate(it)) * added + rate(it) * scales * sums).astype("<f4").astype(np.float64)
            now = now.moved(it, scales, total, logs, docs)
        out = [(p, ADDED, 0, terms[at].astype("<i4").tobytes(), added[at].astype("<f4").tobytes()) for p, at in _split(terms, parts)]
        out.append((-1, FIGURES, 0, b"", np.concatenate([[now.kept], now.total, now.alpha]).tobytes()))
        return _table(out)

    return blocks.filter(F.col("t") > _INFO).withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(run, ROWS)


def _iteration(blocks: DataFrame, state: DataFrame | None, w: Weights, t: int, after: int | None, scale: float, parts: int) -> DataFrame:
    """Rows after iteration t: added weights, figures, and the rows that the
    blocks of the next iteration (``after``) ask for."""
    then_kept = w.kept * (1.0 - rate(t))
    then = Weights(w.k, w.size, w.seed, then_kept, w.total, w.alpha)      # its sums are not used

    def sums(of: dict, rows: list[dict]) -> list[tuple]:
        b = Block(of)
        have, vals = _joined(rows, w.k)
        s, logs, docs = b.added(t, w, have, vals)
        out = [(p, SUMS, 0, b.terms[at].astype("<i4").tobytes(), s[at].astype("<f4").tobytes()) for p, at in _split(b.terms, parts)]
        return [*out, (-1, FIGURES, of["block"], b"", np.concatenate([[docs], s.sum(axis=0), logs]).tobytes())]

    def with_rows(docs: pa.Table, rows: pa.Table) -> pa.Table:
        sent = rows.to_pylist()
        return _table([r for of in docs.to_pylist() for r in sums(of, sent)])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for of in b.to_pylist():
                yield from _table(sums(of, [])).to_batches()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for of in b.to_pylist():
                terms = np.unique(np.frombuffer(of["terms"], "<i4"))
                yield from _table([(p, ASKED, of["block"], terms[at].tobytes(), b"") for p, at in _split(terms, parts)]).to_batches()

    own = blocks.filter(F.col("t") == t).select(*_BLOCKS)
    if state is None:
        rows = own.repartition("block").mapInArrow(alone, ROWS)
    else:
        sent = state.filter(F.col("kind") == SENT)
        rows = own.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(with_rows, ROWS)
        rows = rows.unionByName(state.filter(F.col("kind") == ADDED))
    if after is not None:
        rows = rows.unionByName(blocks.filter(F.col("t") == after).select(*_BLOCKS).mapInArrow(ask, ROWS))

    def update(x: pa.Table) -> pa.Table:
        all_rows = x.to_pylist()
        out = [(r["part"], FIGURES, r["block"], b"", r["vals"]) for r in all_rows if r["kind"] == FIGURES]
        held = [(np.frombuffer(r["terms"], "<i4"), _vals(r["vals"], w.k), r["kind"]) for r in all_rows if r["kind"] in (ADDED, SUMS)]
        if not held:
            return _table(out)
        terms = np.unique(np.concatenate([h[0] for h in held]))
        added, more = np.zeros((len(terms), w.k)), np.zeros((len(terms), w.k))
        for mine, vals, kind in held:
            (added if kind == ADDED else more)[np.searchsorted(terms, mine)] += vals
        added = (1.0 - rate(t)) * added + rate(t) * scale * more
        out.append((all_rows[0]["part"], ADDED, 0, terms.tobytes(), added.astype("<f4").tobytes()))
        return _table([*out, *_answers(then, terms, added, all_rows)])

    return rows.groupBy("part").applyInArrow(update, ROWS)


def _joined(rows: list[dict], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, soft weights) of the rows that a block was sent, ascending."""
    if not rows:
        return np.zeros(0, dtype=np.int32), np.zeros((0, k), dtype=np.float32)
    terms, vals = np.concatenate([np.frombuffer(r["terms"], "<i4") for r in rows]), np.concatenate([_vals(r["vals"], k) for r in rows])
    o = np.argsort(terms)
    return terms[o], vals[o]


def _answers(w: Weights, terms: np.ndarray, added: np.ndarray, rows: list[dict]) -> list[tuple]:
    """Soft weights of the terms that blocks ask for, where something was added."""
    asked = [(r["block"], r["part"], np.frombuffer(r["terms"], "<i4")) for r in rows if r["kind"] == ASKED]
    if not asked:
        return []
    places = []
    for block, part, mine in asked:
        at = np.minimum(np.searchsorted(terms, mine), len(terms) - 1)
        places.append((block, part, at[terms[at] == mine]))
    need = np.unique(np.concatenate([p[2] for p in places]))
    soft = w.soft(w.base(terms[need]) + added[need]).astype("<f4")
    return [(part, SENT, block, terms[at].astype("<i4").tobytes(), soft[np.searchsorted(need, at)].tobytes())
            for block, part, at in places if len(at)]


class OnlineLDA:
    """A fitted model: ``added`` is a written table of ``ROWS``."""

    def __init__(self, weights: Weights, added: DataFrame | None, terms: int, parts: int, path: str | None = None):
        self.weights, self.added, self.terms, self.parts, self.path = weights, added, terms, parts, path
        self._held, self._dealt = None, []

    def drop(self) -> None:
        """Delete the topics, when what was made of them has been written."""
        if self._held is not None:
            self._held.destroy()
            self._held = None
        drop_scratch(SparkSession.active(), *([self.path] if self.path else []), *self._dealt)

    def _broadcast(self, spark: SparkSession):
        """(terms, soft weights) of all terms with added weights."""
        if self._held is None:
            w = self.weights

            def soft(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    for r in b.to_pylist():
                        terms = np.frombuffer(r["terms"], "<i4")
                        vals = w.soft(w.base(terms) + _vals(r["vals"], w.k)).astype("<f4")
                        yield from _table([(r["part"], SENT, 0, r["terms"], vals.tobytes())]).to_batches()

            rows = [] if self.added is None else self.added.mapInArrow(soft, ROWS).select("terms", "vals").toArrow().to_pylist()
            self._held = spark.sparkContext.broadcast(_joined(rows, w.k))
        return self._held

    def transform(self, vectors: DataFrame, *, col: str = "_tf", out: str = "topic_mix") -> DataFrame:
        """``vectors`` with ``out``, the documents' mixtures, instead of ``col``.
        A document without a term has a mixture of zeros."""
        w, spark = self.weights, vectors.sparkSession
        rest = [c for c in vectors.columns if c != col]
        src = vectors.select(*rest, *_terms(vectors, col))
        schema = T.StructType([*(f for f in src.schema.fields if f.name in rest), T.StructField(out, T.ArrayType(T.DoubleType()))])
        names = [*rest, out]

        def mixed(b: pa.RecordBatch | pa.Table, have: np.ndarray, rows: np.ndarray) -> pa.Table:
            t = pa.Table.from_batches([b]) if isinstance(b, pa.RecordBatch) else b
            sizes, flat, counts = _known(*(t.column(c).combine_chunks() for c in ("_size", "_indices", "_values")))
            terms, at = np.unique(flat, return_inverse=True)
            g = mixtures(sizes, at, counts, w.beta(terms, have, rows), w.alpha, first_mixture(w.k, 0, w.seed))
            g = np.where(sizes[:, None] > 0, g / g.sum(axis=1)[:, None], 0.0)
            flat = pa.array(g.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sizes) + 1) * w.k, w.k), pa.int32()), flat)
            return pa.Table.from_arrays([*(t.column(c) for c in rest), lists], names=names)

        def pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            """Slices of at most the terms of a block (a document at least)."""
            ends = np.cumsum(np.asarray(b.column(b.schema.get_field_index("_indices")).value_lengths().fill_null(0)).astype(np.int64))
            lo, limit = 0, max(1, BLOCK_VALUES // w.k)
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, side="right")))
                yield b.slice(lo, hi - lo)
                lo = hi

        if self.terms * w.k <= BROADCAST_VALUES:
            held = self._broadcast(spark)

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    for part in pieces(b):
                        yield from mixed(part, *held.value).to_batches()

            return src.mapInArrow(run, schema)

        parts = self.parts

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 32
            for b in batches:
                for part in pieces(b):
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, block), pa.int64())], names=[*part.schema.names, "_block"])
                    block += 1

        path = scratch_path(spark, "dealt")
        self._dealt.append(path)
        table = src.mapInArrow(deal, T.StructType([*src.schema.fields, T.StructField("_block", T.LongType())]))
        table.write.parquet(path)                   # both sides must see the same blocks
        dealt = spark.read.schema(table.schema).parquet(path)

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                blocks = b.column(1).to_numpy()
                for one in np.unique(blocks):
                    terms = np.unique(np.asarray(b.column(0).filter(pa.array(blocks == one)).flatten())).astype("<i4")
                    yield from _table([(p, ASKED, int(one), terms[at].tobytes(), b"") for p, at in _split(terms, parts)]).to_batches()

        def answer(x: pa.Table) -> pa.Table:
            rows = x.to_pylist()
            have = [r for r in rows if r["kind"] == ADDED]
            if not have:
                return _table([])
            return _table(_answers(w, np.frombuffer(have[0]["terms"], "<i4"), _vals(have[0]["vals"], w.k), rows))

        asked = dealt.select("_indices", "_block").mapInArrow(ask, ROWS)
        sent = asked.unionByName(self.added).groupBy("part").applyInArrow(answer, ROWS)

        def run_block(docs: pa.Table, rows: pa.Table) -> pa.Table:
            if not docs.num_rows:
                return schema_table
            have, vals = _joined(rows.to_pylist(), w.k)
            return mixed(docs, have, vals)

        from pyspark.sql.pandas.types import to_arrow_schema
        schema_table = to_arrow_schema(schema).empty_table()
        return dealt.groupBy("_block").cogroup(sent.groupBy("block")).applyInArrow(run_block, schema)

    def describeTopics(self, n: int = 10, spark: SparkSession | None = None) -> DataFrame:  # noqa: N802 (Spark ML's name)
        """(topic, termIndices, termWeights): the n heaviest terms of each topic."""
        w, parts = self.weights, self.parts
        spark = spark or SparkSession.active()
        step = max(1, SLICE_VALUES // w.k)

        def heaviest(x: pa.Table) -> pa.Table:
            rows = x.to_pylist()
            part = rows[0]["part"]
            have = [r for r in rows if r["kind"] == ADDED]
            terms = np.frombuffer(have[0]["terms"], "<i4") if have else np.zeros(0, dtype=np.int32)
            added = _vals(have[0]["vals"], w.k) if have else np.zeros((0, w.k))
            found = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * w.k
            for lo in range(part, w.size, step * parts):
                mine = np.arange(lo, min(w.size, lo + step * parts), parts)
                weights = w.base(mine)
                a, z = np.searchsorted(terms, [mine[0], mine[-1] + 1])
                weights[np.searchsorted(mine, terms[a:z])] += added[a:z]
                for j in range(w.k):
                    t, v = np.append(found[j][0], mine), np.append(found[j][1], weights[:, j] / w.total[j])
                    o = np.lexsort((t, -v))[:n]
                    found[j] = t[o], v[o]
            return pa.table({"topic": pa.array([j for j in range(w.k) for _ in found[j][0]], pa.int32()),
                             "term": pa.array([int(t) for f in found for t in f[0]], pa.int32()),
                             "weight": pa.array([float(v) for f in found for v in f[1]], pa.float64())})

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield from _table([(i, ASKED, 0, b"", b"") for i in b.column(0).to_pylist()]).to_batches()

        rows = spark.range(0, min(parts, max(1, w.size))).mapInArrow(number, ROWS)
        if self.added is not None:
            rows = rows.unionByName(self.added)
        best = rows.groupBy("part").applyInArrow(heaviest, "topic int, term int, weight double")
        per = best.groupBy("topic").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "term"))), 1, int(n)).alias("z"))
        return per.select("topic", F.col("z.term").alias("termIndices"), F.transform("z.w", lambda x: -x).alias("termWeights"))


def fit_online(vectors: DataFrame, k: int, iterations: int, *, seed: int = 0, col: str = "_tf", local_values: int | None = None) -> OnlineLDA:
    """Fit on the sparse vectors of ``col`` of a written table."""
    spark, k, iterations = vectors.sparkSession, int(k), int(iterations)
    path = scratch_path(spark, "draws")
    limit = LOCAL_VALUES if local_values is None else local_values
    vectors.select(*_terms(vectors, col)).mapInArrow(_blocks(iterations, seed, k), BLOCKS).write.partitionBy("t").parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # a row a partition of the input
    info = [np.frombuffer(r["sizes"], "<i8") for r in blocks.filter(F.col("t") == _INFO).select("sizes").collect()]
    docs, size = sum(int(i[0]) for i in info), max((int(i[1]) for i in info), default=0)
    drawn = sum((i[2:] for i in info), np.zeros(iterations, dtype=np.int64))
    at = [t for t in range(1, iterations + 1) if drawn[t - 1]]        # an iteration that draws nothing changes nothing
    scale = docs / max(1, int(np.ceil(FRACTION * docs)))
    w = Weights(k, size, seed, 1.0, _first_total(spark, size, k, seed), np.full(k, 1.0 / k))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, least, size * k * 4 // PART_BYTES)
    made: str | None = None

    def written(rows: DataFrame) -> DataFrame:
        nonlocal made
        old, made = made, scratch_path(spark, "topics")
        rows.write.partitionBy("kind").parquet(made)
        if old:
            drop_scratch(spark, old)
        return spark.read.schema(ROWS).parquet(made).select("part", "kind", "block", "terms", "vals")

    state = None
    if at and int(drawn.sum()) * k <= limit:
        state = written(_in_one_task(blocks, w, iterations, scale, parts))
        f = np.frombuffer(state.filter(F.col("kind") == FIGURES).first()["vals"], "<f8")
        w = Weights(k, size, seed, float(f[0]), f[1: k + 1], f[k + 1:])
    else:
        for i, t in enumerate(at):
            state = written(_iteration(blocks, state, w, t, at[i + 1] if i + 1 < len(at) else None, scale, parts))
            # a row of 2 k + 1 numbers a block
            f = np.sum([np.frombuffer(r["vals"], "<f8") for r in state.filter(F.col("kind") == FIGURES).orderBy("block").select("vals").collect()], axis=0)
            w = w.moved(t, scale, f[1: k + 1], f[k + 1:], int(f[0]))
    drop_scratch(spark, path)
    added = None if state is None else state.filter(F.col("kind") == ADDED)
    terms = 0 if added is None else int(added.agg(F.sum(F.octet_length("terms"))).first()[0] or 0) // 4
    return OnlineLDA(w, added, terms, parts, made)
