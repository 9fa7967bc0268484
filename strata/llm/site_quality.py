"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

Document evidence: a logistic regression on hashed words (present or not) and five
measures of the text, fitted with numpy on at most FIT_ROWS labelled documents (those
with the least hash of doc_id, so the choice depends on nothing else). Words are chosen
by their chi-square with the label among words in MIN_DOCUMENTS of them, at most
FEATURES; the label is 1 for documents that are unwanted.

Site evidence: with q the classifier's probability, the rates of unwanted documents by
host and by path within a host are beta-distributed around the level above. The strength
of each prior (in documents) comes from the moments of the observed rates, and a site
with few documents shrinks towards its host, a host with few towards the whole corpus:
host = (s g + sum q) / (s + n), path = (t host + sum q) / (t + n), the document itself
left out. The document's log odds move by the log odds of its path against the whole
corpus; it is unwanted from THRESHOLD on.

All documents are scored and all sites counted by grouped aggregation, pre-aggregated
before the shuffle (sums and counts only), so a host with a third of all rows costs one
row a task. Defined cases: null texts have no words; a null host or path is a site of its
own; without labelled documents of both kinds all log odds are 0 before sites and every
document is kept; repeated rows count as often as they occur; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.shared import by_ids, written
from strata.llm.words import NOT_LETTERS, column, hash_words, text_buffer

FIT_ROWS = 20_000
SLOTS = 1 << 20
FEATURES = 256
MIN_DOCUMENTS = 15
MIN_CHI = 30.0
RIDGE = 1.0
THRESHOLD = 0.25
MAX_STRENGTH = 10_000.0
ROWS = 1_000
_SHIFT = np.uint64(64 - SLOTS.bit_length() + 1)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>!@=+"]] = True
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True


def measures(column_: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct word slots of every text, and its five measures: length, shares of
    symbols and capitals, share of distinct words, share of the commonest word."""
    data, offsets = text_buffer(column_)
    words, bounds = hash_words(data, offsets, space=NOT_LETTERS)
    slots = (words >> _SHIFT).astype(np.int32)
    size = np.maximum(np.diff(offsets), 1)
    symbols = np.diff(np.r_[0, np.cumsum(_SYMBOL[data])][offsets]) / size
    capitals = np.diff(np.r_[0, np.cumsum(_CAPITAL[data])][offsets]) / size
    found, rest = [], np.zeros((len(size), 3))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        own, counts = np.unique(slots[a:b], return_counts=True)
        found.append(own)
        if b > a:
            rest[i] = np.log1p(b - a) / 5, len(own) / (b - a), counts.max() / (b - a)
    return found, np.column_stack([rest[:, 0], 10 * symbols, 2 * capitals, rest[:, 1:]])


@dataclass
class Evidence:
    """A fitted classifier: the feature number of every slot (or -1), and the weights."""

    feature: np.ndarray
    weights: np.ndarray

    def log_odds(self, found: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        out = dense @ self.weights[-6:-1] + self.weights[-1]
        for i, own in enumerate(found):
            f = self.feature[own]
            out[i] += self.weights[f[f >= 0]].sum()
        return out


def fit_evidence(found: list[np.ndarray], dense: np.ndarray, unwanted: np.ndarray) -> Evidence:
    """Chi-square selection, then ridge logistic regression by Newton steps."""
    n1, n0 = unwanted.sum(), (1 - unwanted).sum()
    nothing = Evidence(np.full(SLOTS, -1, np.int32), np.zeros(6))
    if not n1 or not n0:
        return nothing
    with_, without = np.zeros(SLOTS), np.zeros(SLOTS)
    for own, bad in zip(found, unwanted):
        (with_ if bad else without)[own] += 1
    seen = with_ + without
    chi = ((n1 + n0) * (with_ * (n0 - without) - without * (n1 - with_)) ** 2
           / np.maximum(seen * (n1 + n0 - seen) * n1 * n0, 1))
    chi[seen < MIN_DOCUMENTS] = 0
    top = np.argsort(-chi, kind="stable")[:FEATURES]
    top = np.sort(top[chi[top] >= MIN_CHI])
    feature = nothing.feature.copy()
    feature[top] = np.arange(len(top))
    x = np.zeros((len(found), len(top) + 6))
    for i, own in enumerate(found):
        f = feature[own]
        x[i, f[f >= 0]] = 1
    x[:, len(top):-1], x[:, -1] = dense, 1
    w = np.zeros(x.shape[1])
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - unwanted) + RIDGE * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(feature, w)


def fit_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Evidence:
    """Fit on at most ``fit_rows`` labelled documents; ``labels`` has doc_id and unwanted (0 or 1)."""
    chosen = (labels.where("doc_id IS NOT NULL AND unwanted IS NOT NULL").groupBy("doc_id").agg(F.max("unwanted").alias("unwanted"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    chosen = written(chosen, "labelled")
    label = {r["doc_id"]: r["unwanted"] for r in chosen.collect()}  # at most fit_rows rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found, dense = measures(column(batch, "text"))
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id").cast(pa.int64()), pa.array([x.tobytes() for x in found], pa.binary()),
                     pa.array([x.tobytes() for x in dense], pa.binary())], names=["doc_id", "found", "dense"])

    rows = (by_ids(docs.select("doc_id", "text"), chosen.select("doc_id"), "left_semi")
            .mapInArrow(run, "doc_id long, found binary, dense binary")
            .dropDuplicates(["doc_id"]).orderBy("doc_id").toLocalIterator())  # the bounded sample, a partition at a time
    ids, found, dense = [], [], []
    for r in rows:
        ids.append(r["doc_id"])
        found.append(np.frombuffer(r["found"], np.int32))
        dense.append(np.frombuffer(r["dense"], np.float64))
    return fit_evidence(found, np.array(dense).reshape(len(ids), 5), np.array([float(label[i]) for i in ids]))


def document_evidence(docs: DataFrame, evidence: Evidence, host: Column, path: Column, keep: list[Column]) -> DataFrame:
    """The kept columns, host, path and the classifier's log odds of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(evidence)
    frame = docs.select(*[c.alias(f"k{i}") for i, c in enumerate(keep)], host.cast("string").alias("host"),
                        path.cast("string").alias("path"), F.col("text").alias("text to judge"))
    names = [n for n in frame.columns if n != "text to judge"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                odds = sent.value.log_odds(*measures(column(batch, "text to judge")))
                yield pa.RecordBatch.from_arrays([*[column(batch, n) for n in names], pa.array(odds, pa.float64())],
                                                 names=[*names, "log_odds"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema if f.name in names)
    return frame.mapInArrow(run, f"{schema}, log_odds double")


def _strength(rates: DataFrame, around: Column) -> float:
    """Documents that a prior is worth, by moments: the spread of site rates beyond sampling noise."""
    row = rates.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("q") / F.col("n") - around) ** 2).alias("spread"),
                    F.sum(around * (1 - around)).alias("noise"), F.sum(F.col("n") * around * (1 - around)).alias("scale")).first()
    if not row["n"] or not row["scale"]:
        return MAX_STRENGTH
    variance = (row["spread"] - row["noise"]) / row["n"]  # between sites
    mean = row["scale"] / row["n"]
    return float(min(MAX_STRENGTH, max(1.0, mean / variance - 1))) if variance > 0 else MAX_STRENGTH


def _logit(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(inside / (1 - inside))


def combine(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Add host_rate, path_rate, p_unwanted and kept to scored documents (host, path, log_odds)."""
    q = 1 / (1 + F.exp(-F.col("log_odds")))
    paths = written(scored.groupBy("host", "path").agg(F.sum(q).alias("q"), F.count("*").alias("n")), "paths")
    hosts = written(paths.groupBy("host").agg(F.sum("q").alias("q"), F.sum("n").alias("n")), "hosts")
    total = hosts.agg(F.sum("q").alias("q"), F.sum("n").alias("n")).first()
    corpus = F.lit(float(total["q"] / total["n"]) if total["n"] else 0.5)
    s = _strength(hosts, corpus)
    shrunk = hosts.select(F.col("host").alias("host_"), F.col("q").alias("host_q"), F.col("n").alias("host_n"),
                          ((s * corpus + F.col("q")) / (s + F.col("n"))).alias("host_mean"))
    sites = paths.join(shrunk, F.col("host").eqNullSafe(F.col("host_")))
    t = _strength(sites, F.col("host_mean"))
    sites = sites.select("host_", F.col("path").alias("path_"), F.col("q").alias("path_q"), F.col("n").alias("path_n"), "host_q", "host_n")
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("host_")) & F.col("path").eqNullSafe(F.col("path_")))
    # the document's own q is left out of its sites
    host_rate = (s * corpus + F.col("host_q") - q) / (s + F.col("host_n") - 1)
    path_rate = (t * F.col("host_rate") + F.col("path_q") - q) / (t + F.col("path_n") - 1)
    odds = F.col("log_odds") + _logit(F.col("path_rate")) - _logit(corpus)
    return (joined.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
            .withColumn("p_unwanted", 1 / (1 + F.exp(-odds))).withColumn("kept", F.col("p_unwanted") < threshold)
            .drop("host_", "path_", "path_q", "path_n", "host_q", "host_n"))


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep: list[Column] | None = None,
          threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Columns k0, k1, ... (``keep``, default doc_id), host, path, log_odds, host_rate, path_rate, p_unwanted, kept."""
    evidence = fit_sample(docs, labels, fit_rows)
    keep = [F.col("doc_id")] if keep is None else keep
    scored = document_evidence(docs, evidence, host, path, keep)
    known = bool(evidence.weights.any())
    return combine(scored, threshold if known else 2.0)


def keep_wanted(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = THRESHOLD,
                fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents, with their columns, that are not judged unwanted."""
    rows = judge(docs, labels, host, path, [F.col(f"`{c}`") for c in docs.columns], threshold, fit_rows)
    return rows.where("kept").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])
