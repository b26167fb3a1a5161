"""Quality by hierarchical empirical Bayes: evidence of a document, and posteriors of its host and path."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farfield.llm.blocks import word_hashes
from farfield.llm.common import stored

#: Labelled documents that the document classifier is fitted on, at most; chosen by a hash of the id.
TRAINED = 10_000
ROUNDS, RATE, RIDGE = 400, 0.5, 1e-4
#: Documents are kept from this posterior on.
KEEP = 0.5
#: Odds that a site can change a document's by, as a natural logarithm: evidence of the text decides against it.
SITE_LOGIT = 2.0

# Classes of bytes: 0 lower-case and bytes of letters beyond ASCII, 1 upper-case, 2 digits, 3 space, 4 line ends, 5 other
# control, and each punctuation mark for itself.
CLASSES = np.full(256, 5, dtype=np.int64)
CLASSES[list(b"abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = 0
CLASSES[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
CLASSES[list(b"0123456789")] = 2
CLASSES[list(b" \t")] = 3
CLASSES[list(b"\n\r\x0b\x0c")] = 4
_marks = [c for c in range(33, 127) if not chr(c).isalnum()]
CLASSES[_marks] = np.arange(6, 6 + len(_marks))
N = 6 + len(_marks)
#: Slots that lower-cased words are hashed into, and what their part weighs beside that of the pairs of classes.
WORDS, WORD_WEIGHT = 1024, 0.5
WIDTH = N * N + WORDS + 2


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of pairs of byte classes and of hashed words, the share of distinct words, and the
    length. The whole text counts."""
    out = np.zeros(WIDTH)
    if len(text) > 1:
        kinds = CLASSES[np.frombuffer(text, dtype=np.uint8)]
        out[: N * N] = np.sqrt(np.bincount(kinds[:-1] * N + kinds[1:], minlength=N * N) / (len(kinds) - 1))
    words = text.lower().split()
    if words:
        plain = np.frombuffer(b" ".join([b"", *words, b""]), dtype=np.uint8)
        edges = np.flatnonzero(plain == 32)
        hashes = word_hashes(plain, edges[:-1] + 1, edges[1:])
        out[N * N : -2] = WORD_WEIGHT * np.sqrt(np.bincount((hashes % np.uint64(WORDS)).astype(np.int64), minlength=WORDS) / len(words))
    words = text.split()
    out[-2] = len(set(words)) / (1 + len(words))
    out[-1] = np.log1p(len(words)) / 10
    return out


def fit(rows: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Logistic regression by accelerated gradient steps: weights, intercept, and the log odds of good in the rows."""
    share = min(1 - 1e-3, max(1e-3, float(good.mean()) if len(good) else 0.5))
    rows, good = rows.astype(np.float32, copy=False), good.astype(np.float32)
    w, b = np.zeros(rows.shape[1], dtype=np.float32), np.float32(np.log(share / (1 - share)))
    v, c = w, b
    step = np.float32(4 * RATE * 4 / (float(np.einsum("ij,ij->", rows, rows)) / len(rows) + 1)) if len(rows) else 0
    for k in range(ROUNDS if len(rows) else 0):
        error = 1 / (1 + np.exp(-(rows @ v + c))) - good
        w_, b_ = v - step * (error @ rows / np.float32(len(rows)) + np.float32(RIDGE) * v), c - step * error.mean()
        ahead = np.float32(k / (k + 3))
        v, c = w_ + ahead * (w_ - w), b_ + ahead * (b_ - b)
        w, b = w_, b_
    w, b = w.astype(np.float64), float(b)
    return w, b, float(np.log(share / (1 - share)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features((t or "").encode()).astype(np.float16).tobytes() for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, type=pa.binary()), batch.column(1)], names=["x", "good"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = TRAINED) -> tuple[np.ndarray, float, float]:
    """Fits the document classifier on at most about `most` labelled documents; fewer if there are fewer."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("good"))
    known = stored(known, "labels")
    part = max(1, -(-known.count() // most))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(part)) == 0)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(sample), "id").select("t", "good").mapInArrow(_featured, "x binary, good double").collect()
    x = np.zeros((len(rows), WIDTH), dtype=np.float32)
    for k, r in enumerate(rows):
        x[k] = np.frombuffer(r["x"], dtype=np.float16)
    return fit(x, np.array([r["good"] for r in rows]))


def evidence(docs: DataFrame, model: tuple[np.ndarray, float, float], id_col: str, text_col: str, sites: list[str]) -> DataFrame:
    """id, host, path, evidence: how much the text changes the log odds of being good."""
    w, b, prior = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [float(features((t or "").encode()) @ w) + b - prior for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(found, type=pa.float64()), batch.column(4)], names=["id", "host", "path", "evidence", "text_hash"])

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"), *[F.col(c).cast("string").alias(n) for c, n in zip(sites, ("host", "path"), strict=True)], F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    return own.mapInArrow(score, "id long, host string, path string, evidence double, text_hash long")


def _strength(groups: DataFrame, mean: float) -> float:
    """How many documents the prior of a site counts as, by the moments of the sites' means: many if sites are alike."""
    n, s = F.col("n"), F.col("s")
    got = groups.agg(F.sum(n * (s / n - mean) ** 2).alias("between"), F.sum("n").alias("n"), F.sum("v").alias("v"), F.count("*").alias("k")).first()
    if not got["n"] or got["k"] < 2:
        return 1e3
    noise = got["k"] * got["v"] / got["n"] / got["n"]
    spread = max(1e-6, got["between"] / got["n"] - noise)
    return float(min(1e4, max(1.0, mean * (1 - mean) / spread - 1)))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """One row per document: id, evidence, host_mean, path_mean, quality (posterior), kept, text_hash and site_hash
    (xxhash64 of the text, and of host and path), by which a row can be found again where ids are repeated or null.

    A null or empty text has the evidence of an empty one; null hosts and paths are sites of their own; rows that
    share an id are judged each by its text; without labels only the sites speak, and all are kept. An empty table
    gives an empty result; other columns are ignored. Documents' posteriors under the global prior are summed by host
    and by path; a site's mean is shrunk towards its parent's by a strength from the spread of the sites, so that
    sparse sites follow the global prior.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    prior = 1 / (1 + float(np.exp(-model[2])))
    rows = stored(evidence(docs, model, id_col, text_col, [host_col, path_col]), "evidence")
    p = 1 / (1 + F.exp(-(F.col("evidence") + model[2])))
    own = rows.withColumn("host", F.coalesce(F.concat(F.lit("h"), "host"), F.lit("n"))).withColumn("path", F.coalesce(F.concat(F.lit("h"), "path"), F.lit("n")))
    paths = stored(own.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * (1 - p)).alias("v")), "paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("v").alias("v")), "hosts")
    total = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    overall = min(1 - 1e-6, max(1e-6, total["s"] / total["n"])) if total["n"] else prior
    by_host, by_path = _strength(hosts, overall), _strength(paths, overall)
    means = hosts.select("host", ((F.col("s") + by_host * overall) / (F.col("n") + by_host)).alias("host_mean"))
    means = paths.join(means, "host").select("host", "path", "host_mean", ((F.col("s") + by_path * F.col("host_mean")) / (F.col("n") + by_path)).alias("path_mean"))
    site = F.greatest(F.lit(-SITE_LOGIT), F.least(F.lit(SITE_LOGIT), _logit(F.col("path_mean")) - float(np.log(overall / (1 - overall)))))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + model[2] + site)))
    out = own.join(means, ["host", "path"]).withColumn("quality", quality)
    site_hash = F.xxhash64("host", "path").alias("site_hash")
    return out.select(F.col("id").alias(id_col), "evidence", "host_mean", "path_mean", "quality", (F.col("quality") >= KEEP).alias("kept"), "text_hash", site_hash)


def without_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """docs without the rows that judge() rejects; all columns stay. Rows go by their id, text, host and path."""
    judged = judge(docs, labels, id_col, text_col, host_col, path_col, label_col)
    gone = stored(judged.where(~F.col("kept")).select(F.struct(F.col(id_col).alias("i"), F.col("text_hash").alias("t"), F.col("site_hash").alias("s")).alias("_key")).distinct(), "gone")
    site = lambda c: F.coalesce(F.concat(F.lit("h"), F.col(c).cast("string")), F.lit("n"))
    key = F.struct(F.col(id_col).cast("long").alias("i"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("t"), F.xxhash64(site(host_col), site(path_col)).alias("s"))
    return docs.withColumn("_key", key).join(gone, "_key", "left_anti").drop("_key")


