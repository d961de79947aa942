"""Quality classifier with hierarchical empirical Bayes: a document's evidence, its path's and its host's posteriors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, bits_for, bound_batches, broadcast_if_small, give_back, maybe_in, row_count_at_most, whole_text, written

#: Labelled documents that the evidence model is fitted on at most, by hash order. Counts and posteriors use all rows.
TRAINING_ROWS = 20_000
#: Part of the fitted good documents that may fall under the threshold.
GOOD_LOST = 0.002
FEATURES = ("symbols", "capitals", "digits", "pipes", "marks", "word_length", "lines", "length", "tiny")
#: Bytes of a text that are counted at once, which bounds the memory for very long ones.
COUNTED_BYTES = 1 << 20


def byte_counts(texts: pa.Array) -> np.ndarray:
    """How often each byte occurs: a row of 256 numbers for each text; null counts as empty."""
    out = np.zeros((len(texts), 256))
    for row, text in zip(out, texts):
        if text.is_valid:
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for at in range(0, len(data), COUNTED_BYTES):
                row += np.bincount(data[at : at + COUNTED_BYTES], minlength=256)
    return out


def features(texts: pa.Array) -> np.ndarray:
    """Shares of kinds of characters and shapes of each text; all zero for the empty text."""
    counts = byte_counts(texts)
    of = lambda letters: counts[:, list(letters)].sum(axis=1)
    n = counts.sum(axis=1) - counts[:, 0x80:0xC0].sum(axis=1)  # code points: bytes that don't continue one
    gaps, some = 1 + of(b" \n\t"), np.maximum(n, 1)
    out = [of(b"#$%&*@^~") / gaps, of(range(65, 91)) / some, of(range(48, 58)) / some, of(b"|<>{}[]\\") / gaps, of(b"!?") / gaps, n / gaps / 10, of(b"\n") / gaps, np.log1p(n) / 10, n < 40]
    return np.where(n == 0, 0.0, np.stack(out)).T


def on_texts(of_features: Callable[[np.ndarray], pa.Array], kind: str, text: Column) -> Column:
    """of_features of the features of a text column, in Arrow batches."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield of_features(features(texts))
        give_back()

    return F.arrow_udf(run, kind)(text)


@dataclass(frozen=True)
class Evidence:
    """A logistic model on features and their squares."""

    weights: tuple[float, ...]
    bias: float
    base: float  # share of good documents it was fitted on
    threshold: float = 0.5

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Row by row, so that a text's evidence doesn't depend on the batch it comes in, as it would in a matrix product."""
        z = (np.concatenate([x, x * x], axis=1) * np.array(self.weights)).sum(axis=1) + self.bias
        return np.round(np.clip(z, -12, 12), 9)


def fit(rows: np.ndarray, good: np.ndarray, steps: int = 60, ridge: float = 1.0) -> Evidence:
    """Newton's method on the ridge-penalised likelihood. Without rows of both kinds the evidence is neutral."""
    if len(good) == 0 or good.min() == good.max():
        return Evidence((0.0,) * (2 * len(FEATURES)), 0.0, 0.5 if len(good) == 0 else float(np.clip(good.mean(), 0.02, 0.98)))
    x = np.concatenate([rows, rows * rows], axis=1)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - good) + penalty * w
        hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    real = w[:-1] / scale
    return Evidence(tuple(real.tolist()), float(w[-1] - real @ mean), float(np.clip(good.mean(), 0.02, 0.98)))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    bound_batches(docs.sparkSession)
    chosen = labels.select(F.col(id_col).alias("t_id"), F.col(label_col).cast("double").alias("t_good")).dropna().groupBy("t_id").agg(F.max("t_good").alias("t_good"))
    chosen = chosen.orderBy(F.xxhash64("t_id"), "t_id").limit(most)  # at most this many ids of 16 bytes are broadcast
    rows = docs.select(F.col(id_col).alias("d_id"), whole_text(text_col).alias("d_text"))
    return rows.join(F.broadcast(chosen), F.col("d_id") == F.col("t_id")).select("t_good", on_texts(lambda x: pa.array(list(x), pa.list_(pa.float64())), "array<double>", F.col("d_text")).alias("x"))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def posteriors(scored: DataFrame) -> DataFrame:
    """For each (host, path): the posterior share of good documents, shrunk to the host's, which is shrunk to the global.

    Prior strengths come from the spread of the groups' means (method of moments). Partial sums go through the shuffle,
    one row a group and task, so the size of a host doesn't matter."""
    sums = (F.sum("p").alias("s"), F.count(F.lit(1)).alias("n"))
    paths = scored.groupBy("host", "path").agg(*sums)
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    world = hosts.agg(F.sum("hs").alias("ws"), F.sum("hn").alias("wn"))
    mean = F.least(F.lit(0.98), F.greatest(F.lit(0.02), F.col("ws") / F.col("wn")))
    world = world.select(mean.alias("mean"))

    def strength(spread: Column, m: Column) -> Column:
        """m(1-m)/variance - 1, within bounds; one group only gives the upper bound."""
        return F.least(F.lit(500.0), F.greatest(F.lit(5.0), F.coalesce(m * (1 - m) / F.greatest(spread, F.lit(1e-9)) - 1, F.lit(500.0))))

    host_spread = hosts.agg(F.var_samp(F.col("hs") / F.col("hn")).alias("host_var"))
    both = paths.alias("a").join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).drop("h")
    path_var = both.agg(F.avg(F.pow(F.col("s") / F.col("n") - F.col("hs") / F.col("hn"), 2)).alias("path_var"))
    numbers = world.join(host_spread).join(path_var).first()  # three numbers
    if numbers is None or numbers["mean"] is None:
        return both.select("host", "path", F.lit(0.5).alias("path_post"), F.lit(0.5).alias("host_post"), F.lit(0.5).alias("world_mean"))
    m = F.lit(numbers["mean"])
    k_host, k_path = strength(F.lit(numbers["host_var"]).cast("double"), m), strength(F.lit(numbers["path_var"]).cast("double"), m)
    both = both.withColumn("host_post", (k_host * m + F.col("hs")) / (k_host + F.col("hn")))
    both = both.withColumn("path_post", (k_path * F.col("host_post") + F.col("s")) / (k_path + F.col("n")))
    return both.select("host", "path", "path_post", "host_post", m.alias("world_mean"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = TRAINING_ROWS) -> Evidence:
    """Fits the evidence and a threshold that keeps all but GOOD_LOST of the good training documents."""
    rows = training_rows(docs, labels, id_col, text_col, label_col, most).collect()  # at most `most` short rows (ids are unique)
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    y = np.array([r["t_good"] for r in rows], float)
    e = fit(x, y)
    good = np.sort(1 / (1 + np.exp(-e.logit(x)[y > 0.5])))
    cut = float(good[int(len(good) * GOOD_LOST)]) if len(good) else 0.5
    return Evidence(e.weights, e.bias, e.base, min(0.5, cut * 0.9))


def classify(docs: DataFrame, evidence: Evidence, host: Column, path: Column, carry: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The columns in carry (as c_0, c_1, ...), host, path, and the evidence as log odds (z) and probability (p)."""
    bound_batches(docs.sparkSession)
    z = on_texts(lambda x: pa.array(evidence.logit(x), pa.float64()), "double", whole_text(text_col))
    base = docs.select(*(F.col(c).alias(f"c_{k}") for k, c in enumerate(carry)), host.cast("string").alias("host"), path.cast("string").alias("path"), z.alias("z"))
    return base.withColumn("p", sigmoid(F.col("z")))


#: So many (host, path) groups are broadcast at most; beyond it narrow rows join them by shuffle.
MOST_GROUPS = 50_000


def judged(scored: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """score joins the evidence's log odds with those of the path's posterior against the global share."""
    g = broadcast_if_small(groups.withColumnsRenamed({"host": "g_host", "path": "g_path"}), MOST_GROUPS)
    rows = scored.join(g, F.col("host").eqNullSafe(F.col("g_host")) & F.col("path").eqNullSafe(F.col("g_path"))).drop("g_host", "g_path")
    shift = logit(F.col("path_post")) - logit(F.col("world_mean"))
    score = sigmoid(F.col("z") + shift)
    limit = F.lit(float(np.log(threshold / (1 - threshold))))
    return rows.withColumn("score", score).withColumn("kept", F.col("z") + shift >= limit)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """One row per row of docs: id, host, path, evidence (p), posteriors, score and kept.

    Labels may repeat (the best counts), hold nulls (ignored) or be empty (neutral evidence: all is kept). Null and empty
    texts, null hosts and paths, null ids and repeated rows each get a row; an empty table gives an empty result."""
    evidence = train(docs, labels, id_col, text_col)
    scored = written(classify(docs, evidence, F.col(host_col), F.col(path_col), (id_col,), text_col), "quality")
    rows = judged(scored, posteriors(scored), evidence.threshold)
    return rows.select(F.col("c_0").alias(id_col), "host", "path", F.col("p").alias("evidence"), "host_post", "path_post", "score", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows of docs that quality() keeps, with their columns; nulls, empty texts, repeats and empty tables as there.

    Texts stay where they are: up to MOST_GROUPS (host, path) groups travel to them; beyond that, rows are judged by their
    host, path and evidence alone, and of the texts only those of rejected rows (and a few more) move."""
    columns = docs.columns
    evidence = train(docs, labels, id_col, text_col)
    scored = classify(docs, evidence, F.col(host_col), F.col(path_col), tuple(columns), text_col)
    named = lambda df: df.select(*(F.col(f"c_{k}").alias(c) for k, c in enumerate(columns)))
    facts = written(scored.select("host", "path", "z", "p"), "quality-evidence")
    groups = written(posteriors(facts), "quality-groups")
    if row_count_at_most(groups, MOST_GROUPS):
        return named(judged(scored, groups, evidence.threshold).filter("kept"))
    # Rows of one host, path and evidence are judged alike.
    alike = [F.col("host"), F.col("path"), F.col("z")]
    out = written(judged(facts.select(*alike).distinct(), groups, evidence.threshold).filter("not kept").select(F.struct(*alike).alias("k")), "quality-rejected")
    bits = bits_for(out.count())
    flagged = maybe_in(scored, F.struct(*alike), bitmap(out, "k", bits), bits, "maybe")
    back = flagged.filter("maybe").join(out, F.struct(*alike) == F.col("k"), "left_anti")
    return named(flagged.filter("not maybe").drop("maybe")).unionByName(named(back.drop("maybe")))
