"""Operator 8, toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learnt from labelled rows: words, and beginnings of words, that occur in far more toxic than other documents,
with weights by smoothed log odds. Features of a whole text: densities of lexicon words and beginnings (also after leet
signs are undone), the largest weights, hits near a second-person word, capitals, punctuation, obfuscated and
stretched words, and length. The trees are fitted on one half of the labelled rows and the lexicon on the other, so
that a word which the lexicon has by chance carries no weight; a quarter of the trees' rows calibrates.

Labels are learnt only from rows whose crc32 fold is not 0, and from ``max_train`` of them at most (those of least hash);
that bound is a parameter. Language, source and id are no inputs of a score.

Defined cases: a null or empty text is scored from features that are all zero; a null id keeps its row, is not held out
and takes no part in learning; rows that repeat an id are scored each by its text, and the least text of a labelled id
teaches; labels of unknown ids, null labels and repeated
labels (the largest counts) are allowed; with no labels of both kinds every score is the prior; no rows give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import spread
from . import boosting
from .common import bounded_batches, crc_fold, id_text, stage, unstage

MAX_TRAIN = 40_000
LEXICON = 6000
BEGIN = (4, 5)
#: Second-person words of the corpus' languages.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestra vuestro su".split())
#: Signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGE = ".,;:!?\"'()[]{}«»¡¿…*#%&$|-_/"
NAMES = ("word_density", "word_sum", "word_max", "begin_density", "begin_sum", "begin_max", "plain_density", "plain_max", "near_you", "you_density", "capitals", "shouted", "exclaims", "signs", "obfuscated", "stretched", "log_words")
NEAR = 4


class _WordRows(dict):
    """Token -> row of a growing matrix of word features; bounded."""

    LIMIT = 300_000

    def __init__(self, row_of, width: int):
        super().__init__()
        self.row_of, self.rows = row_of, np.zeros((4096, width), np.float32)

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[n] = self.row_of(word)
        self[word] = n
        return n

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.rows[at]


class Lexicon:
    def __init__(self, words: dict[str, float], begins: dict[str, float]):
        self.words, self.begins = words, begins
        self._rows: _WordRows | None = None

    def __getstate__(self) -> tuple[dict, dict]:
        return self.words, self.begins

    def __setstate__(self, state: tuple[dict, dict]) -> None:
        self.__init__(*state)

    def _begin(self, w: str) -> float:
        return max((self.begins.get(w[:n], 0.0) for n in BEGIN if len(w) >= n), default=0.0)

    def word_row(self, raw: str) -> tuple[float, ...]:
        """Weight as a word, as a beginning, and with leet signs undone; odd, stretched, second person, capitals, shouted, exclaims, signs."""
        w = raw.lower().strip(EDGE)
        odd, plain = False, 0.0
        if len(w) > 2 and not w.isalpha() and any(map(str.isalpha, w)):  # letters and other signs alternate within the word
            odd = True
            p = "".join(filter(str.isalpha, w.translate(LEET)))
            plain = max(self.words.get(p, 0.0), self._begin(p)) if p != w else 0.0
        stretched = len(set(w)) > 1 and any(w[i] == w[i + 1] == w[i + 2] for i in range(len(w) - 2))
        return (self.words.get(w, 0.0), self._begin(w), plain, odd, stretched, w in YOU, raw[:1].isupper(), len(raw) > 2 and raw.isupper(), raw.count("!"), sum(c in "*#%&$@|" for c in raw))

    def features(self, text: str) -> list[float]:
        words = text.split()
        n = len(words)
        if not n:
            return [0.0] * len(NAMES)
        if self._rows is None:
            self._rows = _WordRows(self.word_row, 10)
        r = self._rows.of(words)
        a, b, plain, you = r[:, 0], r[:, 1], r[:, 2], r[:, 5]
        hit = np.nonzero((a > 0) | (b > 0) | (plain > 0))[0]
        before = np.concatenate([[0], np.cumsum(you)])
        near = int((before[np.minimum(n, hit + NEAR + 1)] > before[np.maximum(0, hit - NEAR)]).sum())
        mean = r.mean(axis=0).tolist()
        return [
            float((a > 0).mean()), mean[0], float(a.max()), float((b > 0).mean()), mean[1], float(b.max()), float((plain > 0).mean()), float(plain.max()), near / n, mean[5],
            mean[6], mean[7], mean[8], mean[9], mean[3], mean[4], float(np.log1p(n)),
        ]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word or beginning, by label, counted within the partition first."""
    toxic, other = Counter(), Counter()
    for b in batches:
        for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            words = {w.strip(EDGE) for w in text.lower().split()}
            keys = {"w" + w for w in words if 1 < len(w) <= 40}
            keys |= {"b" + w[:n] for w in words for n in BEGIN if len(w) > 3 and len(w) >= n}
            (toxic if label else other).update(keys)
        if len(toxic) + len(other) > 400_000:
            yield from _spill(toxic, other)
            toxic, other = Counter(), Counter()
    yield from _spill(toxic, other)


def _spill(toxic: Counter, other: Counter) -> Iterator[pa.RecordBatch]:
    keys = list(toxic.keys() | other.keys())
    for a in range(0, len(keys), 10_000):
        some = keys[a : a + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([toxic[k] for k in some], pa.int64()), pa.array([other[k] for k in some], pa.int64())], ["key", "toxic", "other"])


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, folds: int = 5, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, text, label`` of at most ``max_train`` labelled rows outside fold 0, those of least hash; staged."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.filter(crc_fold(F.col("doc_id"), folds) != 0)
    known = known.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(max_train)
    # At most max_train ids and labels are broadcast, so the texts of the corpus stay where they are.
    # Of the texts of a repeated id the least teaches.
    return stage(id_text(docs).join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")), "train")


def learn_lexicon(train: DataFrame, half: Column, size: int = LEXICON) -> Lexicon:
    rows = train.filter(half)
    n1, n0 = (int(x or 0) for x in rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first())
    if not n1 or not n0:
        return Lexicon({}, {})
    counts = spread(rows.select("text", "label")).mapInArrow(_counts, "key string, toxic long, other long").groupBy("key").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    weight = F.log((F.col("t") + 0.1) / (n1 + 0.2)) - F.log((F.col("o") + 0.1) / (n0 + 0.2))
    least = max(2, min(8, n1 // 50))
    top = counts.filter(F.col("t") >= least).withColumn("w", weight).filter("w > 1.5").orderBy(F.desc(F.col("w") * F.log1p("t")), "key").limit(size).collect()  # bounded by size
    return Lexicon({r["key"][1:]: r["w"] for r in top if r["key"][0] == "w"}, {r["key"][1:]: r["w"] for r in top if r["key"][0] == "b"})


def feature_rows(rows: DataFrame, features, names: tuple[str, ...], extra: str) -> DataFrame:
    """``features(text)`` of each row as an array column beside ``extra`` columns (named with their types)."""
    cols = [c.split()[0] for c in extra.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(x, pa.list_(pa.float64()))], [*cols, "x"])

    return spread(rows.select(*cols, "text")).mapInArrow(run, f"{extra}, x array<double>")


def fit_bounded(rows: DataFrame, features, names: tuple[str, ...], max_train: int, **options) -> boosting.Boosted:
    """Fits the trees on features of the sampled rows; at most ``max_train`` short vectors reach the driver."""
    got = feature_rows(rows, features, names, "doc_id long, label int").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(max_train).collect()
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(names))
    return boosting.fit(x, np.array([r["label"] for r in got], int), **options)


def train_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_train: int = MAX_TRAIN) -> tuple[Lexicon, boosting.Boosted]:
    bounded_batches(docs.sparkSession)
    train = training_rows(docs, labels, label_col, max_train=max_train)
    half = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0
    lexicon = learn_lexicon(train, half)
    model = fit_bounded(train.filter(~half), lexicon.features, NAMES, max_train)
    unstage(train)
    return lexicon, model


def scorer(features, model: boosting.Boosted, n_features: int):
    """A mapInArrow function: the text column becomes a score column, the others stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t or "") for t in b.column("_text").to_pylist()], float).reshape(b.num_rows, n_features)
            rest = [n for n in b.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in rest), pa.array(model.score(x) if b.num_rows else [], pa.float64())], [*rest, "_score"])

    return run


def scored_by(rows: DataFrame, features, model: boosting.Boosted, n_features: int) -> DataFrame:
    """``rows`` with ``_score`` in place of ``_text``."""
    kept = [f for f in rows.schema.fields if f.name != "_text"]
    return spread(rows).mapInArrow(scorer(features, model, n_features), T.StructType([*kept, T.StructField("_score", T.DoubleType())]))


def whole_rows(docs: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs meets one that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def toxicity(docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text", train_on: DataFrame | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    base = id_text(docs, id_col, text_col)
    lexicon, model = train_toxicity(train_on if train_on is not None else base, labels, label_col, max_train)
    scored = scored_by(base.select("doc_id", F.col("text").alias("_text")), lexicon.features, model, len(NAMES))
    return scored.select("doc_id", F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, train_on: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with all columns, in one pass without a shuffle of texts."""
    lexicon, model = train_toxicity(train_on, labels, "toxic", max_train)
    rows = docs.select(whole_rows(docs), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    return scored_by(rows, lexicon.features, model, len(NAMES)).filter("_score < 0.5").select("doc.*")
