"""Quality classifier: document evidence and site evidence by hierarchical empirical Bayes.

1. *Document.* A logistic regression over a few measurements of the whole text gives the log odds
   that it is good. It is fitted on labelled rows, ``MAX_LABELLED`` at most, chosen by a hash of
   the id: a bounded sample, so it may be collected and broadcast.
2. *Sites.* The probabilities of all documents are summed by host and path. Each host's rate is
   shrunk toward the global rate and each path's toward its host's, as under beta priors whose
   strengths are estimated from how much rates vary between hosts, and between the paths of
   hosts, beyond what chance explains. A site with few documents says little about them.
3. *Both.* Posterior log odds = document log odds + log odds of the site - log odds overall. The
   site term is limited to ``MAX_SITE`` so that a bad site alone never condemns a document whose
   own text is clearly good. A document is kept at a posterior of one half or more.

Documents have no address; their ``source`` is the host and ``lang`` the path. ``url_host`` and
``url_path`` give both for pages.

Defined cases: a null or empty text has the measurements 0, so its document evidence is that of
an empty text; null hosts and paths are groups like any other; labels without an id or a quality
are not used, several labels of one id are averaged; without labels of both kinds the document
evidence is 0 and every document is kept; repeated rows and null ids are rows like any other;
empty tables give empty results; ``filter_quality`` keeps all columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import STEP_BYTES, extended, lean, plain_strings, quoted, small_batches, steps, text_bytes, text_or_empty, unused_name
from meterline.workspace import materialize

MAX_LABELLED = 20_000
MAX_SITE = 2.0
RIDGE = 1.0
STRENGTH = (1.0, 1e6)
EDGE = 1e-6
FEATURES = (
    "log_words", "word_length", "symbols", "bangs", "capitals", "digits", "punctuation", "distinct_words", "repeated_lines",
)

# Classes of bytes, for counts over all texts of a batch at once.
_CLASSES = {
    "space": b" \t\n\x0b\x0c\r", "symbol": b"#*$%&|<>", "bang": b"!", "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789", "mark": b".,;:?",
}


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def url_path(url: Column) -> Column:
    """The first directory of the address."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]*)", 1)


def features(texts: pa.Array) -> np.ndarray:
    """One row of measurements (FEATURES) per text; shares are per word or per byte."""
    data, offsets = text_bytes(texts)
    size = np.diff(offsets)
    n = len(size)
    sums = {}
    for name, members in _CLASSES.items():
        flags = np.zeros(256, bool)
        flags[list(members)] = True
        places = np.flatnonzero(flags[data])
        sums[name] = np.diff(np.searchsorted(places, offsets)).astype(float)
    word_count, distinct, repeated = np.zeros(n), np.zeros(n), np.zeros(n)
    for k, text in enumerate(texts.to_pylist()):
        found = text.split()
        word_count[k], distinct[k] = len(found), len(set(found))
        lines = [line for line in text.split("\n") if line]
        repeated[k] = 1 - len(set(lines)) / len(lines) if lines else 0
    per_word, per_byte = np.maximum(word_count, 1), np.maximum(size, 1)
    return np.column_stack([
        np.log1p(word_count), np.minimum((size - sums["space"]) / per_word, 50), np.minimum(sums["symbol"] / per_word, 2),
        np.minimum(sums["bang"] / per_word, 2), sums["capital"] / per_byte, sums["digit"] / per_byte,
        np.minimum(sums["mark"] / per_word, 2),
        # Longer texts have a smaller share of different words; the power of a typical growth takes that out.
        np.minimum(distinct / per_word ** 0.8, 3), repeated,
    ]) if n else np.empty((0, len(FEATURES)))


def document_logits(model: list[float] | None, values: np.ndarray) -> np.ndarray:
    """Log odds of rows of features, within +-20."""
    if model is None:
        return np.zeros(len(values))
    return np.clip(model[0] + values @ np.array(model[1:]), -20, 20)


def _with_features(docs: DataFrame, text: str) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``features``."""
    rows = docs.select(*(quoted(c) for c in docs.columns if c != text), text_or_empty(F.col(quoted(text))).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "_text", STEP_BYTES):
                values = features(plain_strings(step.column(step.num_columns - 1)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)), pa.array(values.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*step.columns[:-1], lists], names=[*step.schema.names[:-1], "features"])

    return small_batches(rows).mapInArrow(lean(run), extended(rows, "features array<double>"))


def with_logits(docs: DataFrame, model: list[float] | None, name: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the document log odds of their texts as column ``name``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for step in steps(batch, text, STEP_BYTES):
                logits = document_logits(model, features(plain_strings(step.column(at))))
                yield pa.RecordBatch.from_arrays([*step.columns, pa.array(logits)], names=[*step.schema.names, name])

    return small_batches(docs).mapInArrow(lean(run), extended(docs, f"{quoted(name)} double", without=0))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", max_labelled: int = MAX_LABELLED) -> list[float] | None:
    """Intercept and weights of the document classifier; None without labels of both kinds."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    # At most max_labelled pairs of numbers: small enough to broadcast whatever the corpus holds.
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    chosen = docs.select("doc_id", text).join(F.broadcast(sample), "doc_id")
    measured = _with_features(chosen, text)
    # Copies of an id could exceed the bound: one row per id is enough for the fit.
    rows = measured.groupBy("doc_id").agg(F.min(F.struct("features", "quality")).alias("r")).orderBy("doc_id").select("r.*").collect()
    x = np.array([row["features"] for row in rows]).reshape(len(rows), len(FEATURES))
    y = np.array([row["quality"] for row in rows], float)
    if not len(y) or y.min() >= 0.5 or y.max() < 0.5:
        return None
    return logistic(x, y).tolist()


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 100, weight: np.ndarray | None = None) -> np.ndarray:
    """Intercept and weights by Newton's method with a ridge penalty on standardised columns.

    ``y`` may lie between 0 and 1; ``weight`` counts each row.
    """
    weight = np.ones(len(x)) if weight is None else weight
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / scale
    return np.concatenate([[w[0] - slopes @ mean], slopes])


def _strength(mean: Column, between: Column, chance: Column) -> Column:
    """Strength of a beta prior from the variance between groups beyond chance."""
    surplus = F.greatest(between - chance, F.lit(EDGE))
    return F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), mean * (1 - mean) / surplus - 1))


def _odds(rate: Column) -> Column:
    inside = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), rate))
    return F.log(inside / (1 - inside))


def site_table(evidence: DataFrame) -> DataFrame:
    """host, path, n_docs, host_rate, path_rate and site_logit from rows (host, path, logit).

    Sums are taken by path first; everything after works on one row per path or host.
    """
    probability = 1 / (1 + F.exp(-F.col("logit")))
    paths = materialize(evidence.groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(probability).alias("s")), "quality-paths")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "quality-hosts")
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s"), F.count(F.lit(1)).alias("hosts")).first()
    if not total["n"]:
        return paths.select("host", "path", F.col("n").cast("long").alias("n_docs"), *(
            F.lit(0.0).alias(name) for name in ("host_rate", "path_rate", "site_logit")))
    mean = min(max(total["s"] / total["n"], EDGE), 1 - EDGE)
    rate = F.col("host_s") / F.col("host_n")
    spread = hosts.agg((F.sum(F.col("host_n") * (rate - mean) ** 2) / total["n"]).alias("v")).select(
        _strength(F.lit(mean), F.col("v"), F.lit(mean * (1 - mean) * total["hosts"] / total["n"])).alias("k")).first()["k"]
    shrunk = materialize(hosts.select(
        F.col("host").alias("_host"), ((F.col("host_s") + spread * mean) / (F.col("host_n") + spread)).alias("host_rate")), "quality-host-rates")
    joined = paths.join(shrunk, F.col("host").eqNullSafe(F.col("_host")))
    own = F.col("s") / F.col("n")
    below = joined.agg(
        (F.sum(F.col("n") * (own - F.col("host_rate")) ** 2) / total["n"]).alias("v"),
        (F.sum(F.col("host_rate") * (1 - F.col("host_rate"))) / total["n"]).alias("chance"),
    ).select(_strength(F.lit(mean), F.col("v"), F.col("chance")).alias("k")).first()["k"]
    path_rate = (F.col("s") + below * F.col("host_rate")) / (F.col("n") + below)
    overall = math.log(mean / (1 - mean))
    limited = F.greatest(F.lit(-MAX_SITE), F.least(F.lit(MAX_SITE), _odds(F.col("path_rate")) - overall))
    return joined.select("host", "path", F.col("n").cast("long").alias("n_docs"), "host_rate", path_rate.alias("path_rate")).withColumn(
        "site_logit", limited)


def _evidence(docs: DataFrame, model: list[float] | None, keep: Sequence[str], text: str, host: Column, path: Column) -> DataFrame:
    """The columns ``keep`` with host, path and logit of every row."""
    sited = docs.select(*map(quoted, keep), host.alias("_site_host"), path.alias("_site_path"), F.col(quoted(text)).cast("string").alias("_body"))
    judged = with_logits(sited, model, "_logit", "_body")
    return judged.select(
        *map(quoted, keep), F.col("_site_host").alias("host"), F.col("_site_path").alias("path"), F.col("_logit").alias("logit"))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", host: Column | None = None, path: Column | None = None,
             id_column: str = "doc_id") -> DataFrame:
    """id, host, path, doc_logit, site_logit, probability and kept of every row."""
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    return judge(docs, fit(docs, labels, text), host, path, text, id_column)


def judge(docs: DataFrame, model: list[float] | None, host: Column, path: Column, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """What ``classify`` gives, by a model that was fitted before, such as on other documents."""
    rows = materialize(_evidence(docs, model, (id_column,), text, host, path), "quality-evidence")
    sites = materialize(site_table(rows), "quality-sites").select(F.col("host").alias("_h"), F.col("path").alias("_p"), "site_logit")
    joined = rows.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    return joined.select(id_column, "host", "path", F.col("logit").alias("doc_logit"), "site_logit").withColumn(
        "probability", 1 / (1 + F.exp(-(F.col("doc_logit") + F.col("site_logit"))))).withColumn("kept", F.col("probability") >= 0.5)


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier keeps, with all their columns.

    The evidence is computed twice, for the sites and for the decision; texts are not shuffled
    unless the table of sites is too large to be broadcast.
    """
    model = fit(docs, labels)
    light = materialize(_evidence(docs, model, ("doc_id",), "text", F.col("source"), F.col("lang")), "quality-evidence")
    sites = materialize(site_table(light), "quality-sites")
    host, path, site, logit = (unused_name(docs, name) for name in ("_host", "_path", "_site_logit", "_doc_logit"))
    sites = sites.select(F.col("host").alias(host), F.col("path").alias(path), F.col("site_logit").alias(site))
    judged = with_logits(docs, model, logit)
    joined = judged.join(sites, F.col("source").eqNullSafe(F.col(host)) & F.col("lang").eqNullSafe(F.col(path)))
    return joined.filter(F.col(logit) + F.col(site) >= 0).select(*map(quoted, docs.columns))
