"""Operator 7: quality by hierarchical empirical Bayes.

1. Document evidence.  A ridge logistic regression over shares of character classes,
   repetition and length is fitted on a bounded sample of labelled rows (``SAMPLE``, chosen by
   a hash of the id).  Its log odds minus the sample's prior log odds are the document's own
   evidence, computed for every whole text where it is scanned.
2. Sites.  The documents' probabilities are summed per path (a host's section) and per
   host (combined before the shuffle).  The global mean is the prior of the hosts and a host's
   posterior mean is the prior of its paths; how strongly sparse sites shrink is estimated
   from the spread between sites by moments, so nothing is tuned by hand.
3. A document's posterior log odds are its evidence plus the log odds of its path's posterior
   mean, taken without the document itself.

The registered query and the pipeline pass source as the host and lang as the path, because
`documents` has no address: the second level is then a prior for a language within its source.
A language with few documents in a source shrinks towards the source's mean, so these are judged by
their evidence and their source; a language that is mostly bad in a source lowers all its documents
there.

Only (host, path, sums) rows are shuffled; the path table is written and joined back, and
Spark broadcasts it only if it is small.

Defined results: a null or empty text has evidence like any other text (all shares 0, length
0); null hosts and paths are sites of their own; without labels of both kinds, evidence is 0 and
everything is kept; repeated rows count as rows; an empty table gives no rows; all columns
are kept and may have any name without a leading ``_q_``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SAMPLE = 20_000
CUT = 0.5
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\t\r", "!?", "|", ".,;:", "$%&*#@^~+=<>", "\"'()[]{}/\\-_`"]


def _class_of() -> np.ndarray:
    out = np.full(256, len(_CLASSES), np.uint8)          # other control characters
    out[128:] = len(_CLASSES) + 1                        # bytes of characters beyond ASCII
    for k, chars in enumerate(_CLASSES):
        out[[ord(c) for c in chars]] = k
    return out


_CLASS_OF = _class_of()
_N_CLASSES = len(_CLASSES) + 2
N_FEATURES = _N_CLASSES + 5


def features(text: str | None) -> np.ndarray:
    """Shares of character classes, repeated characters and words, word and text length."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    out = np.zeros(N_FEATURES)
    if len(raw):
        words = text.split()
        out[:_N_CLASSES] = np.bincount(_CLASS_OF[raw], minlength=_N_CLASSES) / len(raw)
        out[_N_CLASSES:] = [np.count_nonzero(raw[1:] == raw[:-1]) / len(raw), len(set(words)) / max(1, len(words)),
                            min(30.0, len(raw) / max(1, len(words))) / 10, np.log1p(len(raw)) / 10,
                            np.log1p(len(words)) / 10]
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights on the raw features and intercept, by Newton steps on standardised ones."""
    mean, std = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / std, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge * len(x)), 1e-9)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / std, float(w[-1] - (w[:-1] * mean / std).sum())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> tuple[np.ndarray, float] | None:
    """Weights and intercept of the evidence, or None if a class has no labelled document."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).select(
        F.col("doc_id").alias("_q_id"), F.col(label_col).cast("double").alias("_q_label"))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("_q_id"), F.lit(n)) < sample)
    # about `sample` rows of two numbers at most, whatever the size of the tables
    rows = docs.join(F.broadcast(known), F.col(id_col) == F.col("_q_id")).select("_q_label", F.col(text_col).alias("_q_text"))
    vector = F.pandas_udf(lambda s: pd.Series([features(t) for t in s]), "array<double>")
    got = rows.select("_q_label", vector("_q_text").alias("x")).toPandas()
    y = got["_q_label"].to_numpy() if len(got) else np.zeros(0)
    if not len(y) or y.min() == y.max():
        return None
    w, b = fit(np.stack(got["x"].to_list()), y)
    return w, b - float(np.log(y.mean() / (1 - y.mean())))


def evidence(text: Column, model: tuple[np.ndarray, float] | None) -> Column:
    if model is None:
        return F.lit(0.0)
    w, b = model
    score = F.pandas_udf(lambda s: pd.Series([float(np.clip(features(t) @ w + b, -50, 50)) for t in s], dtype="float64"), "double")
    # every text has a score; were it nullable, a filter on the quality would have all texts scored once more, by a second
    # Python worker in the same task, to leave out nulls before the join
    return F.coalesce(score(text), F.lit(0.0))


def _logit(p):
    return F.log(p / (1 - p))


def _strength(sites: DataFrame, mean: Column) -> float:
    """Prior strength from the spread of site means, by moments: between-site variance =
    (spread of the means - their sampling variance), and a beta prior of strength k has
    variance mean (1 - mean) / (k + 1)."""
    v = mean * (1 - mean)
    got = sites.where(F.col("n") > 1).select((F.col("y") / F.col("n") - mean).alias("d"), "n", v.alias("v")).agg(
        F.sum(F.col("n") * F.col("d") * F.col("d")).alias("spread"), F.sum("v").alias("noise"),
        F.sum(F.col("n") * F.col("v")).alias("all_v"), F.sum("n").alias("n")).first()
    if not got["n"] or not got["all_v"]:
        return 10.0
    between = max(0.0, (got["spread"] - got["noise"]) / got["n"])
    return float(min(1e4, max(1.0, got["all_v"] / got["n"] / between - 1))) if between > 0 else 1e4


def site_posteriors(scored: DataFrame, host: str = "_q_host", path: str = "_q_path", p: str = "_q_p") -> DataFrame:
    """``(host, path, n, y, prior, k)`` per path: rows, sum of probabilities, the host's
    posterior mean (the path's prior) and the prior's strength."""
    paths = materialize(scored.groupBy(host, path).agg(F.count(F.lit(1)).alias("n"), F.sum(p).alias("y")), "quality-paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    mean = min(1 - 1e-6, max(1e-6, total["y"] / total["n"])) if total["n"] else 0.5
    hosts = paths.groupBy(host).agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    k_host = _strength(hosts, F.lit(mean))
    hosts = hosts.select(F.col(host).alias("_h2"), ((F.col("y") + k_host * mean) / (F.col("n") + k_host)).alias("prior"))
    paths = materialize(paths.join(hosts, F.col(host).eqNullSafe(F.col("_h2"))).drop("_h2"), "quality-sites")
    return paths.withColumn("k", F.lit(_strength(paths, F.col("prior"))))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
             sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``_q_evidence``, ``_q_prior`` (the site's posterior mean without the
    row) and ``_q_quality`` (posterior probability)."""
    model = train(docs, labels, sample, id_col, text_col)
    p = 1 / (1 + F.exp(-F.col("_q_evidence")))
    scored = docs.withColumn("_q_host", host.cast("string")).withColumn("_q_path", path.cast("string")).withColumn(
        "_q_evidence", evidence(F.col(text_col), model))
    sites = materialize(site_posteriors(scored.select("_q_host", "_q_path", p.alias("_q_p"))), "quality-posteriors").select(
        F.col("_q_host").alias("_q_h2"), F.col("_q_path").alias("_q_p2"), *[F.col(c).alias(f"_q_{c}") for c in ("n", "y", "prior", "k")])
    j = scored.join(sites, F.col("_q_host").eqNullSafe(F.col("_q_h2")) & F.col("_q_path").eqNullSafe(F.col("_q_p2")))
    site = (F.col("_q_y") - p + F.col("_q_k") * F.col("_q_prior")) / (F.col("_q_n") - 1 + F.col("_q_k"))
    site = F.least(F.greatest(site, F.lit(1e-6)), F.lit(1 - 1e-6))
    quality = 1 / (1 + F.exp(-(F.col("_q_evidence") + _logit(F.col("_q_site")))))
    j = j.withColumn("_q_site", site)
    return j.select(*docs.columns, "_q_evidence", F.col("_q_site").alias("_q_prior"), quality.alias("_q_quality"))


def reject(docs: DataFrame, labels: DataFrame, host: Column, path: Column, cut: float = CUT, **names) -> DataFrame:
    """The rows of ``docs`` whose quality reaches ``cut``."""
    if not docs.columns:
        return docs
    return classify(docs, labels, host, path, **names).where(F.col("_q_quality") >= cut).select(*docs.columns)
