"""Document quality with what is known of its site: hierarchical empirical Bayes.

A classifier of the text gives each document evidence. The sums of that evidence over a path and
over its host are Beta posteriors: a host is shrunk toward the global rate, a path toward its host,
each by a prior whose strength is estimated from the variance between hosts and between paths. A
site of few documents therefore says little, one of many says what its documents say. The document's
own odds are then moved by the odds of its path against the global ones. All of it is one pass
over the texts and grouped sums, which Spark aggregates before it shuffles, however large a host is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.llm.common import chunks, map_arrow
from packetflow.llm.logistic import Logistic, sigmoid
from packetflow.llm.quality_rules import labelled_sample
from packetflow.llm.shapes import per_text, repeated_words, split_lines
from packetflow.operators.joins import join_heavy
from packetflow.session import shared_dir

#: Labelled documents that the classifier is fitted on.
SAMPLE_DOCUMENTS = 4000

#: Up to this many paths are broadcast (about 60 bytes each); more are joined under a salted key.
BROADCAST_PATHS = 100_000

#: How far the site may move a document: weight of the path's log odds against the global ones.
SITE_WEIGHT = 0.5

#: A document is kept from this posterior on.
KEEP_FROM = 0.5


def text_features(text: pa.Array) -> np.ndarray:
    """A row of numbers for each text that do not depend on its language."""
    text = pc.fill_null(text, "")
    number = len(text)
    lines = split_lines(text)
    sums = {k: per_text(v, lines.texts, number) for k, v in lines.counts.items()}
    words, repeated = repeated_words(text)
    some = np.maximum(words, 1)
    points = np.maximum(sums["point"] - sums["space"], 1)
    rows = np.bincount(lines.texts, minlength=number)
    return np.column_stack(
        [
            np.log1p(words), np.minimum(sums["symbol"] / some, 2), np.minimum(sums["bar"] / some, 1),
            np.minimum(sums["shout"] / some, 1), sums["upper"] / points, sums["digit"] / points,
            np.minimum(points / some, 30), repeated / some,
            per_text(lines.repeats, lines.texts, number) / np.maximum(rows, 1), words < 50,
        ]
    ).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches):
        rows = [row.tobytes() for row in text_features(chunk.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id"), pa.array(rows, pa.binary()), chunk.column("label")],
            ["doc_id", "row", "label"],
        )


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE_DOCUMENTS) -> Logistic:
    """Fit the classifier of texts on ``labels.quality`` of at most ``size`` documents."""
    sample = labelled_sample(docs, labels, "quality", size)
    rows = (
        map_arrow(sample, _features, "doc_id long, row binary, label int")
        .groupBy("doc_id").agg(F.min("row").alias("row"), F.first("label").alias("label"))
        .orderBy("doc_id").collect()
    )
    width = text_features(pa.array([""])).shape[1]
    x = np.array([np.frombuffer(r["row"]) for r in rows]).reshape(len(rows), width)
    return Logistic.fit(x, np.array([r["label"] for r in rows], float))


def site_columns(site: Column) -> tuple[Column, Column]:
    """Host and first part of the path of a URL, or of a bare name of a source; '' for null."""
    bare = F.regexp_replace(F.coalesce(site, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "[?#].*$", "")
    parts = F.split(bare, "/")
    host = F.regexp_replace(F.lower(parts[0]), "^www\\.", "")
    path = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    return host, F.concat(host, F.lit("/"), path)


def _score(model: Logistic, text: str, target: str, names: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text):
            scores = pa.array(sigmoid(model.logit(text_features(chunk.column(text)))))
            kept = [chunk.column(i) for i, n in enumerate(chunk.schema.names) if n in names]
            yield pa.RecordBatch.from_arrays([*kept, scores], [*names, target])

    return score


def with_evidence(
    docs: DataFrame, model: Logistic, keep: list[str], text: str = "text",
    target: str = "text_score",
) -> DataFrame:
    """The columns ``keep`` of ``docs``, in its order, and what the text alone says."""
    names = [c for c in docs.columns if c in keep]
    schema = docs.select(*[F.col(f"`{c}`") for c in names]).schema.add(target, "double")
    return map_arrow(docs, _score(model, text, target, names), schema)


def _moments(mean: Column, n: str, good: str) -> tuple[Column, Column, Column]:
    """The weighted square distance of group rates from ``mean``, rows and groups."""
    rate = F.col(good) / F.col(n)
    return (
        F.sum(F.col(n) * (rate - mean) ** 2).alias("spread"),
        F.sum(F.col(n)).alias("rows"),
        F.count("*").alias("groups"),
    )


def prior_strength(spread: float, within: float, rows: float, groups: int, squares: float) -> float:
    """How many documents the prior is worth, by the moments of an analysis of variance.

    ``spread`` is the weighted square distance of group rates, ``within`` the variance of one
    document, ``squares`` the sum of squared group sizes. Between groups that differ no more than
    chance makes them, the prior is worth very much; one group alone can not differ.
    """
    if groups < 2 or rows <= 0 or within <= 0:
        return 1e6
    between = (spread - (groups - 1) * within) / max(rows - squares / rows, 1e-9)
    return float(min(max(within / between if between > 1e-12 else 1e6, 1.0), 1e6))


def site_posteriors(evidence: DataFrame) -> DataFrame:
    """``path, site_score, global_score`` for each path of ``host, path, text_score`` rows.

    Sums over paths, then over hosts; only single numbers come to the driver.
    """
    shared_dir(evidence.sparkSession)
    paths = evidence.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("text_score").alias("good"),
        F.sum(F.col("text_score") ** 2).alias("square"),
    ).checkpoint()
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    whole = paths.agg(F.sum("n"), F.sum("good"), F.sum("square")).first()
    n, good, square = int(whole[0] or 0), float(whole[1] or 0), float(whole[2] or 0)
    mean = min(max(good / n if n else 0.5, 1e-4), 1 - 1e-4)
    within = max(square / n - mean**2, 0) if n else 0
    moments = hosts.agg(
        *_moments(F.lit(mean), "host_n", "host_good"), F.sum(F.col("host_n") ** 2.0).alias("squares")
    ).first()
    of_hosts = prior_strength(
        moments["spread"] or 0, within, moments["rows"] or 0, moments["groups"], moments["squares"] or 0
    )
    joined = paths.join(hosts, "host")
    around = F.col("host_good") / F.col("host_n")
    inner = joined.agg(
        *_moments(around, "n", "good"), F.sum(F.col("n") ** 2.0 / F.col("host_n")).alias("squares"),
        F.countDistinct("host").alias("hosts"),
    ).first()
    extra = inner["groups"] - inner["hosts"]
    of_paths = 1e6
    if extra > 0 and within > 0:
        room = max((inner["rows"] or 0) - (inner["squares"] or 0), 1e-9)
        between = ((inner["spread"] or 0) - extra * within) / room
        of_paths = min(max(within / between if between > 1e-12 else 1e6, 1.0), 1e6)
    host_mean = (F.col("host_good") + of_hosts * mean) / (F.col("host_n") + of_hosts)
    site = (F.col("good") + of_paths * host_mean) / (F.col("n") + of_paths)
    result = joined.select("path", site.alias("site_score"), F.lit(mean).alias("global_score"))
    return result.checkpoint()


def _posterior(text_score: str, site_weight: float, before: str = "") -> Column:
    def logit(p: Column) -> Column:
        p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.log(p / (1 - p))

    moved = logit(F.col(before + "site_score")) - logit(F.col(before + "global_score"))
    return 1 / (1 + F.exp(-(logit(F.col(text_score)) + site_weight * moved)))


def _join_sites(
    rows: DataFrame, sites: DataFrame, path: str, spread_by: list[str], bound: int
) -> DataFrame:
    """Bring each row the numbers of its path; a path may hold any share of the rows."""
    if sites.count() <= bound:
        return rows.join(F.broadcast(sites.withColumnRenamed("path", path)), path)
    return join_heavy(rows, sites.withColumnRenamed("path", path), path, spread_by)


def score_documents(
    docs: DataFrame, model: Logistic, site: str = "source", site_weight: float = SITE_WEIGHT,
    keep_from: float = KEEP_FROM, broadcast_paths: int = BROADCAST_PATHS,
) -> DataFrame:
    """``doc_id, host, path, text_score, site_score, score, kept`` of every row of ``docs``.

    ``site`` is a URL or a name; null is the site ''. A null or empty text is scored as an empty
    one. Rows that repeat count as often as they occur, a null id stays null, and a posterior of
    exactly ``keep_from`` is kept. Without labels of both kinds all evidence is even. Columns of
    other names play no part.
    """
    host, path = site_columns(F.col(site))
    rows = docs.select("doc_id", host.alias("host"), path.alias("path"), "text")
    shared_dir(docs.sparkSession)
    evidence = with_evidence(rows, model, ["doc_id", "host", "path"]).checkpoint()
    sites = site_posteriors(evidence.select("host", "path", "text_score"))
    found = _join_sites(evidence, sites, "path", ["doc_id", "text_score"], broadcast_paths)
    scored = found.withColumn("score", _posterior("text_score", site_weight))
    return scored.select(
        "doc_id", "host", "path", "text_score", "site_score", "score",
        (F.col("score") >= keep_from).alias("kept"),
    )


def kept_documents(
    docs: DataFrame, model: Logistic, site: str = "source", site_weight: float = SITE_WEIGHT,
    keep_from: float = KEEP_FROM, broadcast_paths: int = BROADCAST_PATHS,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    host, path = site_columns(F.col(site))
    rows = docs.select(host.alias("host"), path.alias("path"), "text")
    evidence = with_evidence(rows, model, ["host", "path"])
    sites = site_posteriors(evidence)
    sites = sites.withColumnsRenamed({c: f"__{c}" for c in ("site_score", "global_score")})
    marked = with_evidence(
        docs.withColumn("__path", path), model, [*docs.columns, "__path"], target="__text_score"
    )
    found = _join_sites(marked, sites, "__path", ["__text_score", "text"], broadcast_paths)
    kept = found.filter(_posterior("__text_score", site_weight, "__") >= keep_from)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
