"""Operator 4, quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

1. A document classifier (boosted trees over dense features of the whole text, fitted on a bounded sample of labelled
   rows outside the held-out fold) gives each document evidence: the probability p that it is good.
2. Grouped sums give each path (within its host) and each host the number of documents and the sum of p. The global mean
   is a Beta prior for the hosts, and each host's posterior is the prior of its paths. How strongly a level shrinks
   is estimated from the spread of the groups' means beyond what chance explains (method of moments), within bounds; a
   sparse site falls back on its host, a sparse host on the global mean.
3. A document's posterior takes its own evidence and its path's posterior odds, relative to the global odds, without the
   document's own share in its site's sums. Documents with a posterior below one half are rejected.

Sums are partial per task before they are shuffled, so a host with a third of all rows is no hot key; site tables are
broadcast only while they have at most ``BROADCAST_SITES`` rows, else joined with salted rows.

Defined cases: null or empty texts have features that are all zero; null hosts and paths are sites of their own; a
null id keeps its row, is not held out and teaches nothing; repeated rows each count; null, repeated (the largest
counts) or unknown labels are allowed; with no labels of both kinds p is the prior; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_fold, id_text, stage, unstage
from .toxicity import _WordRows, fit_bounded, scored_by, training_rows, whole_rows

MAX_TRAIN = 20_000
BROADCAST_SITES = 20_000
#: Places that a site's rows are dealt to where sites are joined.
SALTS = 32
#: Bounds of a level's strength, in documents.
STRENGTH = (2.0, 1000.0)
#: How far a site may move a document's log odds.
SITE_ODDS = 2.0
#: Frequent function words of the corpus' languages.
STOP = frozenset("the of and to in a is that for on it was with as be by at this from or are an der die und das den von mit zu ist im nicht auf ein eine des für sich de la le les et en un une que pour dans est pas par sur du qui el los las y por con para se no una su al lo como".split())
NAMES = ("mean_len", "max_len", "stop", "capitals", "shouted", "pipes", "bangs", "signs", "digits", "ends", "distinct", "adjacent", "top_share", "line_repeats", "period", "log_words")


def _word_row(raw: str) -> tuple[float, ...]:
    w = raw.lower().strip(".,;:!?*#%&$|")
    return (min(len(raw), 60), w in STOP, raw[:1].isupper(), len(raw) > 1 and raw.isupper(), raw == "|", raw.endswith("!!"), raw[-1] in "*#%&$@~^=+", any(map(str.isdigit, raw)), raw[-1] in ".?!,;:")


class QualityFeatures:
    """``features(text)``; the memory of words is a worker's own."""

    def __init__(self) -> None:
        self._rows: _WordRows | None = None

    def __getstate__(self) -> dict:
        return {}

    def __setstate__(self, state: dict) -> None:
        self._rows = None

    def features(self, text: str) -> list[float]:
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * len(NAMES)
        if self._rows is None:
            self._rows = _WordRows(_word_row, 9)
        r = self._rows.of(words)
        m = r.mean(axis=0).tolist()
        distinct = len(set(words))
        at = np.fromiter(map(self._rows.__getitem__, words), np.int64, n)
        adjacent = float((at[1:] == at[:-1]).mean()) if n > 1 else 0.0
        top = float(np.unique(at, return_counts=True)[1].max()) / n
        lines = text.split("\n")
        pairs = at[1:] * 1_000_003 + at[:-1]
        return [
            m[0], float(r[:, 0].max()), m[1], m[2], m[3], m[4], m[5], m[6], m[7], m[8], distinct / n, adjacent, top,
            1 - len(set(lines)) / len(lines), 1 - len(np.unique(pairs)) / max(len(pairs), 1), float(np.log1p(n)),
        ]


def evidence(rows: DataFrame, labels: DataFrame, train_on: DataFrame, *, label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """``rows`` with the document classifier's probability ``_score`` in place of the text ``_text``."""
    bounded_batches(rows.sparkSession)
    train = training_rows(train_on, labels, label_col, max_train=max_train)
    features = QualityFeatures().features
    model = fit_bounded(train, features, NAMES, max_train, rounds=60)
    unstage(train)
    return scored_by(rows, features, model, len(NAMES))


def _strength(groups: DataFrame, mean: float) -> float:
    """Beta strength by the method of moments over groups of at least two documents; rows n and s (sum of p)."""
    g = groups.filter("n > 1")
    k, n_bar, spread = g.agg(F.count("*"), F.avg(1 / F.col("n")), F.avg((F.col("s") / F.col("n") - mean) ** 2)).first()
    if not k or k < 2:
        return STRENGTH[1]
    chance = mean * (1 - mean)
    between = spread - chance * n_bar
    return float(np.clip(chance / between - 1 if between > 1e-9 else STRENGTH[1], *STRENGTH))


def _logit(c):
    return F.log(c / (1 - c))


def site_posteriors(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """``_host, _path, _site`` per site (sums and counts of the site and its host, strengths of both levels) and the global mean."""
    p = F.col("_score")
    paths = stage(scored.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path")).agg(F.sum(p).alias("_s"), F.count("*").alias("_n")), "sites").withColumnsRenamed({"_s": "s", "_n": "n"})
    s, n = paths.agg(F.sum("s"), F.sum("n")).first()
    mean = float(np.clip((s + 0.5) / (n + 1), 1e-4, 1 - 1e-4)) if n else 0.5
    hosts = paths.groupBy("_host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    k_host = _strength(hosts.select(F.col("hs").alias("s"), F.col("hn").alias("n")), mean)
    k_path = _strength(paths, mean)
    host_rows = hosts.select(F.col("_host").alias("_h"), "hs", "hn")
    sites = paths.join(host_rows, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    site = F.struct("s", "n", "hs", "hn", F.lit(k_host).alias("k_host"), F.lit(k_path).alias("k_path"))
    return sites.select("_host", "_path", site.alias("_site")), mean


def _with_posterior(scored: DataFrame, host: str, path: str) -> DataFrame:
    """``scored`` with ``_host_posterior``, ``_path_posterior`` and ``_posterior`` beside ``_score``."""
    sites, mean = site_posteriors(scored, host, path)
    if sites.count() <= BROADCAST_SITES:
        joined = scored.join(F.broadcast(sites), scored[host].eqNullSafe(F.col("_host")) & scored[path].eqNullSafe(F.col("_path")))
    else:  # a site's rows go to SALTS places, so that one with a third of all rows is split; ``scored`` is staged, so a row's number stays
        sites = sites.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = scored.withColumn("_row_salt", F.monotonically_increasing_id() % SALTS)
        joined = joined.join(sites, F.col(host).eqNullSafe(F.col("_host")) & F.col(path).eqNullSafe(F.col("_path")) & (F.col("_row_salt") == F.col("_salt"))).drop("_salt", "_row_salt")
    p = F.col("_score")
    # Without the document's own share.
    at_host = (F.col("_site.k_host") * mean + F.col("_site.hs") - p) / (F.col("_site.k_host") + F.col("_site.hn") - 1)
    at_path = (F.col("_site.k_path") * F.col("_host_posterior") + F.col("_site.s") - p) / (F.col("_site.k_path") + F.col("_site.n") - 1)
    bounded = lambda c: F.least(F.greatest(c, F.lit(1e-4)), F.lit(1 - 1e-4))
    moved = F.least(F.greatest(_logit(F.col("_path_posterior")) - float(np.log(mean / (1 - mean))), F.lit(-SITE_ODDS)), F.lit(SITE_ODDS))
    out = joined.withColumn("_host_posterior", bounded(at_host)).withColumn("_path_posterior", bounded(at_path))
    out = out.withColumn("_posterior", 1 / (1 + F.exp(-(_logit(bounded(p)) + moved))))
    return out.drop("_host", "_path", "_site")


def quality(docs: DataFrame, labels: DataFrame, *, host: str = "source", path: str = "lang", id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, evidence, host_posterior, path_posterior, score, kept`` per row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # Only small columns are staged: texts are read once for training and once for evidence.
    scored = stage(evidence(rows, labels, id_text(docs, id_col, text_col), max_train=max_train), "evidence")
    out = _with_posterior(scored, "host", "path")
    return out.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), F.col("_score").alias("evidence"), F.col("_host_posterior").alias("host_posterior"), F.col("_path_posterior").alias("path_posterior"), F.col("_posterior").alias("score"), (F.col("_posterior") >= 0.5).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, train_on: DataFrame, *, host: str = "source", path: str = "lang", max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` whose posterior is at least one half, with all their columns."""
    rows = docs.select(whole_rows(docs), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    scored = stage(evidence(rows, labels, train_on, max_train=max_train), "evidence")
    return _with_posterior(scored, "host", "path").filter("_posterior >= 0.5").select("doc.*")
