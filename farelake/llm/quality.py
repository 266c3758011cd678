"""Quality by hierarchical empirical Bayes: a document classifier's evidence, and posteriors of its path and host."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sampled, shuffled, stored, without
from .logistic import fit, sigmoid

#: Labelled documents that the classifier is fitted on at most, those with the smallest hashes of their ids.
SAMPLE = 40_000
#: Sites up to this number are broadcast, as a few numbers each.
BROADCAST_SITES = 200_000
#: Documents whose posterior is below this are rejected.
LEAST = 0.5

FEATURES = (
    "upper share",
    "sign share",
    "bar share",
    "doubled signs",
    "digit share",
    "repeated neighbour",
    "distinct share",
    "commonest share",
    "long words",
    "few words",
    "log words",
)


def features(text: str | None) -> np.ndarray:
    """Numbers about the form of a text, each from 0 to about 1."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    signs = sum(counts[ord(c)] for c in "%&$#*!@^~=+<>{}[]\\_")
    doubled = sum(w[-1:] == w[-2:-1] and not w[-1:].isalnum() for w in words)
    neighbours = sum(a == b for a, b in zip(words, words[1:], strict=False))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    return np.array(
        [
            upper / max(1, upper + lower),
            min(1.0, 5 * signs / size),
            min(1.0, 10 * counts[ord("|")] / size),
            doubled / n,
            min(1.0, 5 * counts[48:58].sum() / size),
            neighbours / n,
            len(seen) / n,
            max(seen.values(), default=0) / n,
            sum(len(w) > 25 for w in words) / n,
            1.0 if len(words) < 5 else 0.0,
            np.log1p(len(words)) / 10,
        ]
    )


def expanded(x: np.ndarray) -> np.ndarray:
    """Features, whether each is clearly there, and their squares."""
    return np.column_stack([x, x > 0.02, x > 0.1, x * x])


@dataclass(frozen=True)
class Classifier:
    weights: tuple[float, ...]
    bias: float
    base: float


def _evidence(model: Classifier):
    weights = np.array(model.weights)

    def evidence(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return pd.Series(expanded(x) @ weights + model.bias)

    # A filter on what follows from it would otherwise be carried below it, with an evaluation and workers of its own.
    return F.pandas_udf(evidence, "double").asNondeterministic()


def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t) for t in texts])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Classifier from ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id``, ``quality`` 0 or 1), at most
    ``sample`` of them."""
    known = sampled(labels.select("doc_id", "quality").where(F.col("quality").isNotNull()), sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.select("doc_id", "quality", F.pandas_udf(_features, "array<double>")("text").alias("x"))
    # One text for each id, so the rows are bounded by the sample.
    rows = rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).toPandas()
    y = rows["quality"].to_numpy(np.float64)
    x = np.array(rows["x"].tolist()).reshape(len(y), len(FEATURES))
    weights, bias = fit(expanded(x), y, ridge=0.3)
    return Classifier(tuple(weights.tolist()), bias, float((y.sum() + 0.5) / (len(y) + 1.0)))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame) -> float:
    """Documents that the prior counts for: by moments, how far the means of groups spread within what they belong to,
    beyond their own noise. ``n``, ``p``, ``pp``: count, sum and sum of squares of a group; ``all_n``, ``all_p``: of
    what it belongs to."""
    share = F.col("n") / F.col("all_n")
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum("pp").alias("pp"),
        F.sum(F.col("p") * F.col("p") / F.col("n")).alias("own"),
        F.sum(share * F.col("all_p") * F.col("all_p") / F.col("all_n")).alias("above"),
        F.sum(share * F.col("n")).alias("nn"),
        (F.count(F.lit(1)) - F.sum(share)).alias("free"),
        F.count(F.lit(1)).alias("k"),
    ).first()
    if not row["n"] or row["free"] < 0.5 or row["n"] - row["nn"] < 1e-6:
        return 100.0
    within = max(row["pp"] - row["own"], 1e-9) / max(row["n"] - row["k"], 1)
    variance = (row["own"] - row["above"] - row["free"] * within) / (row["n"] - row["nn"])
    return float(min(max(within / variance if variance > 0 else 1e6, 1.0), 1e6))


@dataclass(frozen=True)
class Sites:
    """Sums over the documents of each path and its host, and what the priors count for."""

    table: DataFrame
    host_strength: float
    path_strength: float
    mean: float
    small: bool


def sites(scored: DataFrame) -> Sites:
    """From (``host``, ``path``, ``logit``) of all documents. Sums are grouped before they are shuffled."""
    p = 1 / (1 + F.exp(-F.col("logit")))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("p"), F.sum(F.col("v") * F.col("v")).alias("pp")]
    paths = stored(scored.withColumn("v", p).groupBy("host", "path").agg(*sums), "paths")
    hosts = stored(paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n", "p", "pp")]), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("p").alias("p")).first()
    mean = min(max((total["p"] or 0.0) / max(total["n"] or 0, 1), 1e-3), 1 - 1e-3)
    above = hosts.select("host", F.col("n").alias("host_n"), F.col("p").alias("host_p"))
    table = paths.select("host", "path", "pp", F.col("n").alias("path_n"), F.col("p").alias("path_p"))
    table = stored(table.join(shuffled(above), "host"), "sites")
    small = table.count() <= BROADCAST_SITES
    of_all = hosts.select("n", "p", "pp", F.lit(total["n"]).alias("all_n"), F.lit(total["p"]).alias("all_p"))
    of_host = table.selectExpr("path_n n", "path_p p", "pp", "host_n all_n", "host_p all_p")
    return Sites(table.drop("pp"), _strength(of_all), _strength(of_host), mean, small)


def posterior(scored: DataFrame, known: Sites, base: float) -> DataFrame:
    """``scored`` with ``probability``: its own evidence, on the odds of the other documents of its path. A path's rate
    is drawn to its host's, and a host's to that of all documents, the more the fewer documents it has."""
    table = F.broadcast(known.table) if known.small else shuffled(known.table)
    own = 1 / (1 + F.exp(-F.col("logit")))
    a, b = known.host_strength, known.path_strength
    host = (a * known.mean + F.col("host_p") - own) / (a + F.col("host_n") - 1)
    path = (b * host + F.col("path_p") - own) / (b + F.col("path_n") - 1)
    path = F.least(F.greatest(path, F.lit(1e-3)), F.lit(1 - 1e-3))
    odds = F.col("logit") - float(np.log(base / (1 - base))) + _logit(path)
    joined = scored.join(table, ["host", "path"])
    return joined.withColumn("probability", 1 / (1 + F.exp(-odds))).drop("path_n", "path_p", "host_n", "host_p")


def _placed(docs: DataFrame, model: Classifier) -> DataFrame:
    """``host``: what comes before the first slash of ``source``; ``path``: the rest of it, and the language."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(
        "*",
        F.substring_index(source, "/", 1).alias("host"),
        F.concat_ws("/", F.regexp_extract(source, "/(.*)$", 1), F.coalesce("lang", F.lit(""))).alias("path"),
        _evidence(model)("text").alias("logit"),
    )


_OWN = ["host", "path", "logit", "probability", "kept", "path_n", "path_p", "host_n", "host_p"]


def grade(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = LEAST) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``lang``, ``source``, others) with ``host``, ``path``, ``logit`` (the
    classifier's), ``probability`` (that quality is 1) and ``kept`` (whether that is at least ``least``).

    ``labels`` has ``doc_id`` and ``quality``; unlabelled ids and labels without a document are left out when fitting.
    Sums over sites cover all documents. Without labels every probability is one half, and all are kept.

    Null and empty texts are graded as texts without words; null sources and languages are a site of their own. Rows
    that repeat count each time and are graded alike. Input columns named like one of the result's are replaced, others
    stay. An empty table gives an empty result.
    """
    docs = without(docs, _OWN)
    model = learn(docs, labels, sample)
    scored = stored(_placed(docs.select("text", "lang", "source"), model).select("host", "path", "logit"), "evidence")
    graded = posterior(_placed(docs, model), sites(scored), model.base)
    return graded.withColumn("kept", F.col("probability") >= least)
