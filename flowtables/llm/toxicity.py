"""Toxicity severity by cumulative-link ordinal regression over sparse word features.

The model has one weight vector and ascending thresholds: the chance of a grade of at most j
is sigmoid(threshold[j] - weights . features). All grades share the weights, so rare severe
grades learn from the mild ones. The result is the expected grade.

Features are words and beginnings of words, so that a stem counts whatever follows it, and
words of one language needn't be frequent among the toxic texts of all languages.

Labels say only whether a text is toxic. Toxic training texts are graded by how dense the
words and beginnings are that mark toxic texts: those with a mean share of a toxic text at
least ``LIFT`` times that of another. Toxic texts without any are of the lowest toxic grade;
no label is left out of training.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import id_text, staged

#: Labelled rows that are fitted at most: those with the smallest hash of their id.
TRAIN_ROWS = 20_000
#: Words that are features at most: those whose presence tells most of the label (chi-squared).
MAX_WORDS = 2_000
#: Beginnings of words, of so many characters, and how many of them are features at most. A longer
#: stem has its first six.
PREFIXES, MAX_PREFIXES = (4, 6), 500
#: Training texts a word must be in, and toxic ones if it marks them.
MIN_TEXTS = 5
#: Severity grades: 0 for texts that aren't toxic.
GRADES = 4
#: What makes a word mark toxic texts: the ratio of its mean shares of toxic and of other texts.
LIFT = 8.0
#: Shares of texts are counted in millionths; the other texts have this much more of any word.
_PARTS, _MORE = 1_000_000, 10_000
#: How many missed toxic texts a rejected clean one outweighs (by their shares).
CLEAN_COST = 5.0
#: Factor of all features, which are roots of small shares.
SCALE = 10.0
_WORDS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class SeverityModel:
    """Feature words and beginnings with their weights, the thresholds between grades, and from which chance a text is toxic."""

    weights: dict[str, float]
    thresholds: np.ndarray
    reject: float = 0.5
    prefixes: dict[str, float] = field(default_factory=dict)

    def grade_chances(self, score: np.ndarray) -> np.ndarray:
        """Chance of each grade, one row per score."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds, -60, 60)))
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)


def _fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int, steps: int = 300, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds with the least mean negative log-likelihood (Adam on all rows)."""
    n, cuts = len(grade), GRADES - 1
    below = np.array([(np.sum(grade <= j) + 0.5) / (n + 1) for j in range(cuts)])
    start = np.log(below / (1 - below))
    # Thresholds as a first value and positive gaps, which keeps them ascending.
    x = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        gaps = np.exp(x[n_features + 1 :])
        cut = np.concatenate([[-np.inf], x[n_features] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(rows, values * x[columns], n)
        upper, lower = (1 / (1 + np.exp(-np.clip(c - score, -60, 60))) for c in (cut[grade + 1], cut[grade]))
        chance = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        slope = np.zeros_like(x)
        slope[:n_features] = np.bincount(columns, values * ((du - dl) / n)[rows], n_features) + ridge * x[:n_features]
        by_cut = np.zeros(cuts)
        inner = grade < cuts
        by_cut -= np.bincount(grade[inner], du[inner] / n, cuts)
        by_cut += np.bincount(grade[~(grade == 0)] - 1, dl[~(grade == 0)] / n, cuts)
        slope[n_features] = by_cut.sum()
        slope[n_features + 1 :] = [by_cut[j + 1 :].sum() * gaps[j] for j in range(cuts - 1)]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        x -= 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8) / math.sqrt(1 + step / 30)
    return x[:n_features], x[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(x[n_features + 1 :]))])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", max_rows: int = TRAIN_ROWS) -> SeverityModel | None:
    """Fit on at most ``max_rows`` labelled documents; None if toxic or other ones are missing.

    Of several labels of one id the largest counts; null ids, null labels and labels without a
    document are ignored. Words are counted in Spark; what reaches the driver are counts of at
    most ``MAX_WORDS`` words and ``MAX_PREFIXES`` beginnings in the bounded sample.
    """
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = id_text(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")
    words = texts.select("doc_id", "toxic", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(_WORDS), F.lit(0))).alias("word"))
    # Dealt by document, so that counts of beginnings need no exchange; its words are counted before.
    counts = words.groupBy("doc_id", "toxic", "word").agg(F.count("*").alias("n")).repartition("doc_id").persist()
    try:
        sizes = counts.groupBy("doc_id", "toxic").agg(F.sum("n").alias("total"))
        totals = sizes.toArrow().to_pandas()
        toxic, clean = int((totals["toxic"] > 0).sum()), int((totals["toxic"] == 0).sum())
        if not toxic or not clean:
            return None
        # Words have size 0, beginnings their number of characters.
        begins = F.filter(F.array(*[F.struct(F.lit(k).alias("size"), F.substring("word", 1, k).alias("piece")) for k in PREFIXES]), lambda p: F.length("word") >= p["size"])
        pieces = counts.select("doc_id", "toxic", "word", "n", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("size"), F.col("word").alias("piece"))), begins)).alias("p")).select("doc_id", "toxic", "word", "n", "p.size", "p.piece")
        cells = pieces.groupBy("doc_id", "toxic", "size", "piece").agg(F.sum("n").alias("n"), F.min(F.xxhash64("word")).alias("least"), F.max(F.xxhash64("word")).alias("most"))
        shares = cells.join(F.broadcast(sizes.select("doc_id", "total")), "doc_id").withColumn("share", F.expr(f"n * {_PARTS} div total"))
        bad = F.col("toxic") > 0
        frequency = shares.groupBy("size", "piece").agg(
            F.count(F.when(bad, 1)).alias("in_toxic"), F.count(F.when(~bad, 1)).alias("in_clean"),
            F.sum(F.when(bad, F.col("share")).otherwise(0)).alias("of_toxic"), F.sum(F.when(~bad, F.col("share")).otherwise(0)).alias("of_clean"),
            F.min("least").alias("least"), F.max("most").alias("most"),
        )
        texts_with = F.col("in_toxic") + F.col("in_clean")
        off = F.col("in_toxic") * clean - F.col("in_clean") * toxic
        telling = F.round(off * off / (texts_with * (toxic + clean - texts_with + 1)), 6)
        marked = (F.col("of_toxic") / toxic >= LIFT * (F.col("of_clean") + _MORE) / clean) & (F.col("in_toxic") >= MIN_TEXTS)
        # A beginning of one word alone is that word.
        common = staged(frequency.where((texts_with >= MIN_TEXTS) & ((F.col("size") == 0) | (F.col("least") != F.col("most")))).select("size", "piece", telling.alias("telling"), marked.alias("marked")), "toxicity-pieces")
        best = [common.where(which).orderBy(F.desc("telling"), "size", "piece").limit(most) for which, most in (("size = 0", MAX_WORDS), ("size > 0", MAX_PREFIXES))]
        vocabulary = best[0].unionByName(best[1]).drop("telling").toArrow().to_pandas().sort_values(["size", "piece"], ignore_index=True)
        if vocabulary.empty:
            return None
        index = counts.sparkSession.createDataFrame(vocabulary.assign(feature=np.arange(len(vocabulary)))[["size", "piece", "feature"]])
        found = pieces.join(F.broadcast(index), ["size", "piece"]).groupBy("doc_id", "feature").agg(F.sum("n").alias("n"))
        cells = found.select("doc_id", F.col("feature").cast("int"), F.col("n").cast("int")).toArrow().to_pandas()
    finally:
        counts.unpersist()
    totals = totals.sort_values("doc_id", ignore_index=True)
    rows = np.searchsorted(totals["doc_id"].to_numpy(), cells["doc_id"].to_numpy())
    columns, n = cells["feature"].to_numpy(), cells["n"].to_numpy()
    total = totals["total"].to_numpy().astype(float)
    dense = np.bincount(rows, n * _marks(vocabulary)[columns], len(totals)) / total
    is_toxic = totals["toxic"].to_numpy() > 0
    grade = is_toxic.astype(np.int64)
    graded = is_toxic & (dense > 0)
    if graded.any():
        grade[graded] = 1 + np.searchsorted(np.quantile(dense[graded], [1 / 3, 2 / 3]), dense[graded], "right")
    order = np.lexsort((columns, rows))
    rows, columns = rows[order], columns[order]
    values = SCALE * np.sqrt(n[order] / total[rows])
    weights, thresholds = _fit(rows, columns, values, grade, len(vocabulary))
    words, begins = (dict(zip(vocabulary["piece"][of], weights[of].tolist())) for of in (vocabulary["size"] == 0, vocabulary["size"] > 0))
    model = SeverityModel(words, thresholds, prefixes=begins)
    chance = 1 - model.grade_chances(np.bincount(rows, values * weights[columns], len(totals)))[:, 0]
    model.reject = _cut(chance, is_toxic)
    return model


def _marks(vocabulary: pd.DataFrame) -> np.ndarray:
    """Which features mark, without those that begin as a shorter one does: no word counts twice."""
    begins = set(vocabulary["piece"][(vocabulary["size"] > 0) & vocabulary["marked"]])
    covered = [any(piece[:k] in begins for k in PREFIXES if k < size or not size and k <= len(piece)) for size, piece in zip(vocabulary["size"], vocabulary["piece"])]
    return vocabulary["marked"].to_numpy() & ~np.array(covered, bool)


def _cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The chance that parts toxic training texts from others best, halfway (in odds) between its neighbours.

    A clean text that is rejected weighs as much as ``CLEAN_COST`` toxic ones that are missed.
    """
    order = np.argsort(-chance, kind="stable")
    odds = np.log(chance[order].clip(1e-12, 1 - 1e-12)) - np.log1p(-chance[order].clip(1e-12, 1 - 1e-12))
    hits, false = np.cumsum(toxic[order]) / max(1, toxic.sum()), np.cumsum(~toxic[order]) / max(1, (~toxic).sum())
    gain = hits - CLEAN_COST * false
    gain[:-1][np.diff(odds) == 0] = -np.inf  # equal chances stay together
    best = int(np.argmax(gain))
    middle = (odds[best] + (odds[best + 1] if best + 1 < len(odds) else odds[best])) / 2
    return float(1 / (1 + np.exp(-middle)))


def severity(docs: DataFrame, model: SeverityModel | None, id_col: str = "doc_id", text_col: str = "text", reject: float | None = None) -> DataFrame:
    """Expected severity of every document: doc_id, severity, toxic_chance and toxic.

    ``toxic_chance`` is that of any grade above 0, and ``toxic`` says that it exceeds
    ``reject`` (by default the model's own bound). Features are shares of a text's words, so whole texts of any length are
    comparable. Null and empty texts and texts without words have severity 0 and aren't toxic,
    nor is anything under no model (null severity). Rows with null or repeated ids are scored like others.
    """
    rows = id_text(docs, id_col, text_col)
    if model is None:
        return rows.select("doc_id", F.lit(None).cast("double").alias("severity"), F.lit(None).cast("double").alias("toxic_chance"), F.lit(False).alias("toxic"))
    scored = rows.select("doc_id", scorer(model)("text").alias("s"))
    return scored.select("doc_id", "s.severity", "s.toxic_chance", (F.col("s.toxic_chance") > (model.reject if reject is None else reject)).alias("toxic"))


def without_toxic(docs: DataFrame, model: SeverityModel | None, text_col: str = "text", reject: float | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text isn't toxic by ``severity``."""
    if model is None:
        return docs
    chance = scorer(model)(F.coalesce(F.col(text_col), F.lit("")))["toxic_chance"]
    return docs.where(chance <= (model.reject if reject is None else reject))


#: Distinct words whose features a task remembers.
_CACHE = 200_000


class _Features(dict):
    """Numbers of the features of a word: itself and its beginnings, which are numbered after the words."""

    def __init__(self, model: SeverityModel):
        self.words = {w.encode(): k for k, w in enumerate(model.weights)}
        self.begins = {p.encode(): k for k, p in enumerate(model.prefixes, len(self.words))}
        # A whole character ends where the next begins, so beginnings can be cut by bytes.
        self.sizes = sorted({len(p) for p in self.begins})

    def __missing__(self, word: bytes) -> list[int]:
        found = [self.words[word]] if word in self.words else []
        found += [self.begins[word[:k]] for k in self.sizes if k <= len(word) and word[:k] in self.begins]
        if len(self) >= _CACHE:
            self.clear()
        self[word] = found
        return found


def scorer(model: SeverityModel):
    """A function of a text column: (severity, toxic_chance)."""

    @F.pandas_udf("struct<severity double, toxic_chance double>")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Every byte that is no ASCII letter and below 128 ends a word, as in the pattern for training.
        fold = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
        features = _Features(model)
        weight = np.array([*model.weights.values(), *model.prefixes.values()])
        for batch in texts:
            scores, empty = np.zeros(len(batch)), np.zeros(len(batch), bool)
            for i, text in enumerate(batch):
                words = text.encode().translate(fold).split()
                empty[i] = not words
                found = [k for word in words for k in features[word]]
                if found:
                    own, counts = np.unique(found, return_counts=True)
                    scores[i] = weight[own] @ (SCALE * np.sqrt(counts / len(words)))
            chances = model.grade_chances(scores)
            yield pd.DataFrame({"severity": np.where(empty, 0.0, chances @ np.arange(GRADES)), "toxic_chance": np.where(empty, 0.0, 1 - chances[:, 0])})

    return lambda text: score(F.lower(text))
