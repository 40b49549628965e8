"""Use of Spark ML models: linear SVM, LDA topic mixtures, cross-validation.

The solvers are Spark's; what lives here is how the study uses them:
scoring by raw margin, topic mixtures averaged per subject, k-fold grid
search where the first best grid point wins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC
from pyspark.ml.clustering import LDA
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BASELINE_GRID, LDA_ITERATIONS, LDA_K, N_FOLDS, SVM_ITERATIONS, SVM_REG
from ..operators.features import BROADCAST_NAMES, mean_vector_by_key, with_sparse_vectors
from ..operators.sampling import fold_assignment
from ..operators.text import dense_index, term_counts, vocabulary
from ..session import drop_scratch, materialize, scratch_path
from .topics import fit_online


@dataclass
class LinearModel:
    weights: list[float]
    intercept: float
    model: object = None

    def score(self, df: DataFrame, features: str = "features", out: str = "score") -> DataFrame:
        """Raw margin. A fitted model scores vectors itself, so that sparse
        ones stay sparse."""
        if self.model is None or not isinstance(df.schema[features].dataType, VectorUDT):
            return linear_score(df, self.weights, self.intercept, features=features, out=out)
        m = self.model.copy()
        m = m.setFeaturesCol(features).setRawPredictionCol("_raw").setPredictionCol("_prediction")
        return (m.transform(df).withColumn(out, vector_to_array("_raw")[1])
                .drop("_raw", "_prediction"))


def _as_array(df: DataFrame, features: str):
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(F.col(features))
    return F.col(features)


def linear_score(df: DataFrame, weights: Sequence[float], intercept: float = 0.0, *,
                 features: str = "features", out: str = "score") -> DataFrame:
    """Raw margin w . x + b as a JVM expression (no model object needed)."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    dot = F.aggregate(F.zip_with(_as_array(df, features), w, lambda a, b: a * b), F.lit(0.0),
                      lambda acc, x: acc + x)
    return df.withColumn(out, dot + F.lit(float(intercept)))


def fit_svm(points: DataFrame, iterations: int = SVM_ITERATIONS, reg: float = SVM_REG,
            intercept: bool = True, *, features: str = "features", label: str = "label") -> LinearModel:
    """Linear SVM on (label, features vector): Spark ML's hinge-loss solver."""
    m = LinearSVC(featuresCol=features, labelCol=label, maxIter=int(iterations), regParam=float(reg),
                  fitIntercept=bool(intercept), standardization=False).fit(points)
    return LinearModel([float(x) for x in m.coefficients.toArray()], float(m.intercept), m)


def _dealt(docs: DataFrame) -> DataFrame:
    """Documents dealt by their number: whole token lists move once, and
    neither their counts nor their vectors are shuffled after that."""
    return docs.repartition("_doc")


@dataclass
class TopicModel:
    vocabulary: DataFrame          # (term, n, term_index), a written table
    size: int                      # number of terms
    lda: object

    def vectors(self, tok: DataFrame, *, tokens: str = "tokens") -> DataFrame:
        """``tok`` with ``_tf``, the sparse vector of its known terms' counts, as
        a written table; rows without a known term are left out."""
        rest = [c for c in tok.columns if c != tokens]
        docs = _dealt(tok.filter(F.size(tokens) > 0).select(F.monotonically_increasing_id().alias("_doc"), *tok.columns))
        counts = term_counts(docs, doc=["_doc", *rest], tokens=tokens)
        known = F.broadcast(self.vocabulary) if self.size <= BROADCAST_NAMES else self.vocabulary
        pairs = counts.join(known.select("term", "term_index"), "term")
        v = pairs.groupBy("_doc", *rest).agg(F.sort_array(F.collect_list(F.struct("term_index", "n"))).alias("_p"))
        return with_sparse_vectors(v.select(*rest, "_p"), self.size, F.col("_p.term_index"), F.col("_p.n"), "_tf").drop("_p")

    def transform(self, tok: DataFrame, *, tokens: str = "tokens") -> DataFrame:
        return self.lda.transform(self.vectors(tok, tokens=tokens))


def fit_topics(tok: DataFrame, k: int = LDA_K, iterations: int = LDA_ITERATIONS, *,
               seed: int = 0, tokens: str = "tokens", optimizer: str = "online",
               vocab_size: int | None = None) -> TopicModel:
    """Term counts and LDA. Documents without tokens carry no topic
    information and are left out.

    The vocabulary is a distributed count, numbered by (count descending,
    term); ``vocab_size`` keeps the most frequent terms (all by default, as in
    the study). ``optimizer="em"`` is the study's optimizer, Spark ML's, with a k x V
    topic matrix on the driver; the online one, the default here, spreads the topics and
    does not build a graph over all documents per iteration.
    ``tok`` is read twice: a written table is best.
    """
    return _fitted_topics(tok.select(tokens), k, iterations, seed=seed, tokens=tokens, optimizer=optimizer, vocab_size=vocab_size)[0]


def _fitted_topics(tok: DataFrame, k: int, iterations: int, *, seed: int, tokens: str, optimizer: str,
                   vocab_size: int | None) -> tuple[TopicModel, DataFrame]:
    """``fit_topics`` and the vectors of ``tok`` that it was fitted on."""
    terms = dense_index(vocabulary(tok, tokens=tokens), [F.desc("n"), F.col("term")], out="term_index")
    if vocab_size is not None:
        terms = terms.filter(F.col("term_index") < int(vocab_size))
    terms = materialize(terms.select("term", "n", F.col("term_index").cast("int").alias("term_index")))
    model = TopicModel(terms, terms.count(), None)
    vectors = model.vectors(tok, tokens=tokens)
    model.lda = fit_lda(vectors, k, iterations, seed=seed, optimizer=optimizer)
    return model, vectors


def fit_lda(vectors: DataFrame, k: int = LDA_K, iterations: int = LDA_ITERATIONS, *, seed: int = 0, optimizer: str = "online"):
    """LDA over the column ``_tf`` of a written table. The online optimizer's topics
    are spread over the cluster (``topics``). With Spark ML's other one each partition
    makes a k x V matrix an iteration, and their sums meet on the driver: no more
    partitions than cores."""
    if optimizer == "online":
        return fit_online(vectors, k, iterations, seed=seed)
    dealt = vectors.coalesce(max(1, vectors.sparkSession.sparkContext.defaultParallelism))
    return LDA(k=int(k), maxIter=int(iterations), optimizer=optimizer, seed=int(seed), featuresCol="_tf",
               topicDistributionCol="topic_mix").fit(dealt)


class TopicCube:
    """Term vectors of notes at many marks, from one count of their tokens.

    A note is seen from its mark on (``mark``, a place in the sequence of marks). Terms
    are numbered by (first mark of a note that has them, count descending, term), so
    the vocabulary of mark m is the numbers below ``sizes[m]``, and the vectors of mark m
    are those of the mark before and the new notes' ones, under a larger size."""

    def __init__(self, notes: DataFrame, marks: int, *, vocabulary_of: str = "train", part: str = "part", mark: str = "mark",
                 pid: str = "pid", tokens: str = "tokens"):
        """``notes``: (pid, part, mark, tokens); the notes of one part make
        the vocabulary."""
        spark = notes.sparkSession
        docs = _dealt(notes.select(F.monotonically_increasing_id().alias("_doc"), pid, part, mark, tokens))
        # a row for every term of every note: compressed columns, gone when the notes' pairs are written
        path = scratch_path(spark, "counts")
        table = term_counts(docs, doc=["_doc", pid, part, mark], tokens=tokens)
        table.write.parquet(path)
        counts = spark.read.schema(table.schema).parquet(path)
        seen = counts.filter(F.col(part) == vocabulary_of).groupBy("term").agg(F.min(mark).alias("first"), F.sum("n").alias("n"))
        terms = dense_index(seen, [F.col("first"), F.desc("n"), F.col("term")], out="term_index")
        self.vocabulary = materialize(terms.select("term", "n", "first", F.col("term_index").cast("int").alias("term_index")))
        # one number a mark
        new = {r["first"]: r["k"] for r in self.vocabulary.groupBy("first").agg(F.count(F.lit(1)).alias("k")).collect()}
        self.sizes = [sum(new.get(j, 0) for j in range(m + 1)) for m in range(marks)]
        known = self.vocabulary.select("term", "term_index")
        pairs = counts.join(F.broadcast(known) if (self.sizes or [0])[-1] <= BROADCAST_NAMES else known, "term")
        per = pairs.groupBy("_doc", pid, part, mark).agg(F.sort_array(F.collect_list(F.struct("term_index", "n"))).alias("_p"))
        # read once or twice a mark: a table of plain columns
        self.path = scratch_path(spark, "notes")
        per = per.select(pid, part, mark, F.col("_p.term_index").alias("indices"), F.col("_p.n").cast("array<double>").alias("values"))
        per.write.parquet(self.path)
        self.notes = spark.read.schema(per.schema).parquet(self.path)
        drop_scratch(spark, path)
        self.part, self.mark, self.pid = part, mark, pid

    def drop(self) -> None:
        """Delete the notes' table, when what was made of it has been written."""
        drop_scratch(self.notes.sparkSession, self.path)

    def _seen(self, m: int, *parts: str) -> DataFrame:
        """The parts' notes that mark m sees and that have a term of its vocabulary: numbers are ascending."""
        at = self.notes.filter(F.col(self.part).isin(*parts) & (F.col(self.mark) <= m))
        return at.filter(F.col("indices")[0] < self.sizes[m])

    def terms(self, m: int, *parts: str) -> DataFrame:
        """(pid, part, _tf) as ``vectors`` has them, but that ``_tf`` is a struct (for
        ``topics``, which passes over numbers from its size on): nothing is written."""
        return self._seen(m, *parts).select(self.pid, self.part, F.struct(F.lit(self.sizes[m]).alias("size"), "indices", "values").alias("_tf"))

    def vectors(self, m: int, part: str, path: str | None = None) -> DataFrame:
        """(pid, _tf) of a part's notes that are seen at mark m and have a
        term of its vocabulary; no token is counted again. A table written at
        ``path``."""
        known = F.filter("indices", lambda x: x < self.sizes[m])
        at = self._seen(m, part).select(self.pid, known.alias("_i"), F.slice("values", 1, F.size(known)).alias("_v"))
        return with_sparse_vectors(at, self.sizes[m], F.col("_i"), F.col("_v"), "_tf", path=path).drop("_i", "_v")


def topic_features(tok: DataFrame, k: int = LDA_K, iterations: int = LDA_ITERATIONS, *,
                   seed: int = 0, pid: str = "pid", tokens: str = "tokens", optimizer: str = "online",
                   vocab_size: int | None = None,
                   model: TopicModel | None = None) -> tuple[DataFrame, TopicModel]:
    """(pid, features = mean topic mixture over the subject's notes)."""
    own = tok.select(pid, tokens)
    if model is None:                      # its own notes' vectors are at hand
        model, vectors = _fitted_topics(own, k, iterations, seed=seed, tokens=tokens, optimizer=optimizer, vocab_size=vocab_size)
    else:
        vectors = model.vectors(own, tokens=tokens)
    return mean_vector_by_key(model.lda.transform(vectors), pid, "topic_mix", out="features"), model


def topic_top_terms(model: TopicModel, n: int = 10) -> DataFrame:
    """(topic, rank, term, weight): the n heaviest terms of every topic. The
    k x n rows of the topics are the small side of the join."""
    topics = model.lda.describeTopics(int(n))
    z = topics.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "z"))
    z = z.select("topic", "rank", F.col("z.termIndices").alias("term_index"),
                 F.col("z.termWeights").alias("weight"))
    return (model.vocabulary.join(F.broadcast(z), "term_index")
            .select("topic", "rank", "term", "weight"))


def cv_grid(points: DataFrame, grid: Mapping[str, Sequence] = BASELINE_GRID, k: int = N_FOLDS, *,
            seed: int = 0, key: str = "pid", features: str = "features",
            label: str = "label", parallelism: int = 1) -> tuple[DataFrame, dict]:
    """k-fold grid search of the linear SVM by mean AUC.

    Folds come from ``fold_assignment`` (reproducible); the first grid point
    with the highest mean AUC wins, as in the study. Returns one row per grid
    point and the best parameters. The solver draws nothing: a fit that converged
    before its last iteration is also that of more iterations.
    """
    ev = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    data = fold_assignment(points, k, seed, key=key)
    points_of_grid = [(bool(i), int(t), float(r)) for i in grid["intercept"] for t in grid["iterations"] for r in grid["reg"]]
    auc: dict[tuple, list[float]] = {g: [] for g in points_of_grid}

    def fits(job: tuple) -> dict[tuple, float]:
        """AUC of all iterations of one (intercept, reg) on one fold."""
        intercept, reg, train, held_out = job
        out, model, value = {}, None, None
        for t in sorted({t for _, t, _ in points_of_grid}):
            if model is None or model.summary().totalIterations >= last:
                model = LinearSVC(featuresCol=features, labelCol=label, standardization=False, fitIntercept=intercept,
                                  maxIter=t, regParam=reg).fit(train)
                value, last = ev.evaluate(model.transform(held_out)), t
            out[intercept, t, reg] = float(value)
        return out

    pairs = list(dict.fromkeys((i, r) for i, _, r in points_of_grid))
    with ThreadPool(max(1, int(parallelism))) as pool:
        for f in range(k):
            train, held_out = data.filter(F.col("fold") != f).cache(), data.filter(F.col("fold") == f).cache()
            if train.isEmpty() or held_out.isEmpty():
                raise ValueError(f"fold {f} has no points to train on or to test")
            for found in pool.map(inheritable_thread_target(fits), [(i, r, train, held_out) for i, r in pairs]):
                for g, value in found.items():
                    auc[g].append(value)
            train.unpersist()
            held_out.unpersist()
    rows = [(n, *g, sum(auc[g]) / k) for n, g in enumerate(points_of_grid)]
    best_i = max(range(len(rows)), key=lambda i: (rows[i][4], -i))
    out = points.sparkSession.createDataFrame(
        [r + (r[0] == best_i,) for r in rows],
        "grid_point int, intercept boolean, iterations int, reg double, mean_auc double, best boolean")
    b = rows[best_i]
    return out, {"intercept": b[1], "iterations": b[2], "reg": b[3], "mean_auc": b[4]}
