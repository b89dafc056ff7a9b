"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words is trained with numpy on confirmed toxic
texts (P) and unlabelled ones (U).  With the class prior ``pi`` and the logistic
loss ``l`` the risk is ``pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)])``:
the second term estimates the risk on clean texts from unlabelled ones, and
where a batch drives it below zero its gradient is taken the other way.

P and U are bounded samples (``MAX_POSITIVE``, ``MAX_UNLABELLED``: the rows with
the smallest hash of their id); scores are computed for every whole text.

Cases: null text is empty and is scored by the bias alone; without confirmed
toxic rows the score is the prior (0 without any label); labels that are null
are no labels, several for one id count as toxic if one is; repeated rows are
scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import query, table
from geoframe.llm.tokens import ChunkCache

BITS = 18
MAX_POSITIVE = 6_000       # training texts taken from the confirmed ones
MAX_UNLABELLED = 12_000    # and from all others that may be learned from
FOLDS = 5                  # ids whose crc32 is 0 modulo this are held out
EPOCHS = 20
BATCH = 256
RATE = 0.02
DECAY = 1e-4
SEED = 11
GRAM = 4                   # characters in a gram of a word
MIN_SCORE = 5.0            # standard errors between P and U for a feature to be used
WORD = re.compile(r"\w+")


def _indexes(word: str) -> bytes:
    """Hashed features of a word: itself and its grams, its ends marked."""
    marked = f"^{word}$"
    grams = [word] + [marked[i:i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))]
    return np.array([zlib.crc32(g.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
                     for g in grams], dtype="int32").tobytes()


class Features:
    """Distinct hashed features of a text (int32)."""

    def __init__(self):
        self.known = ChunkCache(_indexes)

    def __call__(self, text: str) -> np.ndarray:
        words = set(WORD.findall(text.lower()))
        return np.unique(np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype="int32"))


_FEATURES = Features()


def _features(batches):
    for batch in batches:
        found = [_FEATURES(t or "").tobytes() for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["x", "p"])


class Rows:
    """Sparse rows: the sum of weights of each, and its gradient."""

    def __init__(self, rows: list[np.ndarray]):
        self.index = np.concatenate(rows) if rows else np.zeros(0, "int32")
        self.lengths = np.array([len(r) for r in rows], dtype="int64")
        self.ends = np.concatenate([[0], np.cumsum(self.lengths)])

    def take(self, which: np.ndarray):
        index = np.concatenate([self.index[self.ends[i]:self.ends[i + 1]] for i in which])
        return index, np.repeat(np.arange(len(which)), self.lengths[which])


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features whose share of texts differs between P and U by at least
    ``MIN_SCORE`` standard errors."""
    size, n_p, n_u = 1 << BITS, len(positive), len(unlabelled)
    p = np.bincount(np.concatenate(positive), minlength=size)
    u = np.bincount(np.concatenate(unlabelled), minlength=size)
    share = (p + u + 1) / (n_p + n_u + 2)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    return np.abs(p / n_p - u / n_u) >= MIN_SCORE * error


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
          epochs: int = EPOCHS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Weights (float32) and bias, by Adam on mini-batches."""
    size, used = 1 << BITS, telling(positive, unlabelled)
    positive = [x[used[x]] for x in positive]
    unlabelled = [x[used[x]] for x in unlabelled]
    w = np.zeros(size + 1)
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    w[size] = np.log(prior / (1 - prior))
    rng = np.random.default_rng(seed)
    p_rows, u_rows, step = Rows(positive), Rows(unlabelled), 0
    n_u = len(unlabelled)
    for _ in range(epochs):
        order = rng.permutation(n_u)
        for at in range(0, n_u, BATCH):
            u = order[at:at + BATCH]
            p = rng.integers(0, len(positive), BATCH)
            pi, pr = p_rows.take(p)
            ui, ur = u_rows.take(u)
            fp = _sigmoid(w[size] + np.bincount(pr, w[pi], len(p)))
            fu = _sigmoid(w[size] + np.bincount(ur, w[ui], len(u)))
            clean = -np.log1p(-np.minimum(fu, 1 - 1e-9)).mean() + prior * np.log1p(
                -np.minimum(fp, 1 - 1e-9)).mean()
            # d l(f) = f - 1 and d l(-f) = f for the logistic loss
            if clean >= 0:
                gp, gu = prior * ((fp - 1) - fp) / len(p), fu / len(u)
            else:
                gp, gu = prior * fp / len(p), -fu / len(u)
            grad = np.bincount(pi, gp[pr], size + 1) + np.bincount(ui, gu[ur], size + 1)
            grad[size] = gp.sum() + gu.sum()
            grad[:size] += DECAY * w[:size]
            step += 1
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:size].astype("float32"), float(w[size])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
        toxic: str = "toxic") -> tuple[np.ndarray, float]:
    """Learn from ids that are not held out."""
    ours = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS != 0
    marks = (labels.select(F.col(id_col).alias("id"), F.col(toxic).alias("y")).where("y IS NOT NULL")
             .where(ours).groupBy("id").agg(F.max("y").alias("y")))
    n, n_toxic = marks.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not n_toxic:
        return np.zeros(1 << BITS, "float32"), -30.0
    prior = min(max(n_toxic / n, 1e-3), 0.5)
    few = lambda df, k: df.orderBy(F.xxhash64("id"), "id").limit(k)
    some = (few(marks.where("y = 1").select("id"), MAX_POSITIVE).withColumn("p", F.lit(True)))
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").where(ours)
    some = some.unionAll(few(ids, MAX_UNLABELLED).withColumn("p", F.lit(False)))
    rows = (docs.select(F.col(id_col).alias("id"), text).join(some, "id")
            .select(text, "p").mapInArrow(_features, "x binary, p boolean").toArrow())
    x = [np.frombuffer(b, dtype="int32") for b in rows.column("x").to_pylist()]
    is_p = rows.column("p").to_pylist()
    # the order of rows as they arrive is not fixed; theirs by content is
    order = sorted(range(len(x)), key=lambda i: x[i].tobytes())
    positive = [x[i] for i in order if is_p[i]]
    unlabelled = [x[i] for i in order if not is_p[i]]
    if not positive or not unlabelled:
        return np.zeros(1 << BITS, "float32"), float(np.log(prior / (1 - prior)))
    return train(positive, unlabelled, prior)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Per row of ``docs``: id and ``score`` (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # 2**BITS weights, whatever the input
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        w, bias = shared.value
        for batch in batches:
            z = [bias + float(w[_FEATURES(t.as_py() or "")].sum(dtype="float64")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_sigmoid(np.array(z)))],
                                             names=[id_col, "score"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, score double")


@query("op4_toxicity_nnpu")
def op4(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0)
                         .alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
