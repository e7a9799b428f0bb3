"""Toxic documents by multiple-instance learning.

A document is a bag of sentences; only the bag is labelled. Sentence probabilities are
sigmoid(bias + sum of the weights of the sentence's features) and combine by noisy-or:
P(document) = 1 - (1 - P0) * product(1 - P(sentence) beyond P0), where P0 = sigmoid(bias) is the background
of a document, counted once: a sentence adds what its features raise it above P0, one without features
nothing, so a clean text's score doesn't grow with its length. Weights and bias are trained from
document labels by gradient descent on the log loss of that, so the model itself finds which sentences
carry a label, and `scored` names them in its column sentences.

Features are words and their character 5-grams (with word ends), so inflected forms count too. They
are chosen by how much more often toxic training documents hold them: counted by Spark over the
training sample, the strongest `features` go to the model.

Training is bounded: at most `rows` labelled documents (a parameter), one row each, chosen by a hash of
doc_id, from those whose crc32(doc_id as text) mod 5 is not 0. Only text is an input of a score. Scores cover every
row and its whole text.

Edge cases: null or empty text has the score of the background, as any without features; without labels of both
classes every score is 0; a doc_id labelled twice has its more frequent label (1 at a tie), one in
several rows lends the text with the smallest hash; each row gets a score; null doc_id is scored and not held out; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, schema_of, tuned
from .learning import marked, platt, sigmoid

SENTENCE = re.compile(r"[^.!?\n]+")
_OUTSIDE = re.compile(r"^\W+|\W+$")
GRAM = 5
#: A feature is at least this many times as common in toxic training documents as in others.
RATIO = 4.0
#: Words of which a worker keeps the features.
CACHE_WORDS = 300_000


def features_of(word: str) -> list[str]:
    """The bare word and its character 5-grams; ^ and $ mark its ends."""
    w = _OUTSIDE.sub("", word.lower())
    if not w:
        return []
    marked = f"^{w}$"
    return [f"={w}", *{marked[i : i + GRAM] for i in range(max(1, len(marked) - GRAM + 1))}]


class Scorer:
    """Scores of texts; features of words met before are kept."""

    def __init__(self, names: list[str], weight: np.ndarray, bias: float, scale: tuple[float, float] = (1.0, 0.0)):
        """scale: slope and shift that calibrate the logit of the noisy-or."""
        self.scale = scale
        self.at = {n: i for i, n in enumerate(names)}
        self.weight, self.bias = weight, bias
        self.seen: dict[str, tuple[int, ...]] = {}
        # every feature of a word is a piece of its lowered text: texts without any piece need no look at words
        self.pieces = ahocorasick.Automaton()
        for n in names:
            self.pieces.add_word(n.strip("^$=") or n, True)
        self.pieces.make_automaton()

    def plain(self, text: str) -> bool:
        """Whether no word of the text can have a feature."""
        return not self.at or next(self.pieces.iter(text.lower()), None) is None

    def learn(self, words: set[str]) -> None:
        if len(self.seen) + len(words) > CACHE_WORDS:
            self.seen.clear()
        at = self.at
        for w in words.difference(self.seen):
            self.seen[w] = tuple({at[f] for f in features_of(w) if f in at})

    def bag(self, text: str) -> list[tuple[int, int, list[int]]]:
        """The sentences with features: start, end, feature numbers."""
        if self.plain(text):
            return []
        self.learn(set(text.split()))
        seen = self.seen
        found = []
        for m in SENTENCE.finditer(text):
            own: set[int] = set()
            for w in m[0].split():
                f = seen.get(w)
                if f is None:
                    self.learn({w})
                    f = seen[w]
                if f:
                    own.update(f)
            if own:
                found.append((m.start(), m.end(), sorted(own)))
        return found

    def sentence(self, own: list[int]) -> float:
        return float(sigmoid(np.array(self.bias + self.weight[own].sum())))

    def score(self, text: str, least: float = 0.5) -> tuple[float, list[tuple[int, int, float]]]:
        """(noisy-or score, sentences of probability `least` or more)."""
        p = [(s, e, self.sentence(own)) for s, e, own in self.bag(text)]
        base = np.log1p(-float(sigmoid(np.array(self.bias))))
        clean = base + sum(min(0.0, np.log1p(-min(x, 1 - 1e-12)) - base) for _, _, x in p)
        return float(calibrated(np.array([-np.expm1(clean)]), self.scale)[0]), [x for x in p if x[2] >= least]


def calibrated(q: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
    q = np.clip(q, 1e-9, 1 - 1e-9)
    return sigmoid(scale[0] * (np.log(q) - np.log1p(-q)) + scale[1])


class Bags:
    """Bags of sentences as flat arrays: feature numbers, the sentence of each, the bag of each sentence."""

    def __init__(self, sizes: list[np.ndarray], flat: list[np.ndarray]):
        """For each bag, sizes: features of each sentence that has some; flat: those features."""
        join = lambda x: np.concatenate([*x, np.zeros(0, dtype=np.uint16)]).astype(np.int32)
        self.count, size, self.flat = len(sizes), join(sizes), join(flat)
        found = np.array([len(s) for s in sizes], dtype=np.int64)
        self.owner = np.repeat(np.arange(self.count, dtype=np.int32), found)
        self.sent = np.repeat(np.arange(len(size), dtype=np.int32), size)


def train(bags: Bags, y: np.ndarray, features: int, steps: int = 300, ridge: float = 1e-4) -> tuple[np.ndarray, float, tuple[float, float]]:
    """Weights, bias and calibration of the noisy-or model, by Adam on the whole sample."""
    n, flat, sent, owner = bags.count, bags.flat, bags.sent, bags.owner
    size = np.zeros(len(owner))
    w, b = np.zeros(features), -6.0
    m1, v1 = np.zeros(features + 1), np.zeros(features + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(sent, weights=w[flat], minlength=len(size)) if len(size) else np.zeros(0)
        p, p0 = sigmoid(z), float(sigmoid(np.array(b)))
        up = p >= p0  # sentences that say no less than the background
        log_clean = np.log1p(-p0) + np.bincount(owner, weights=np.where(up, np.log1p(-np.minimum(p, 1 - 1e-9)) - np.log1p(-p0), 0.0), minlength=n)
        q = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-9)
        # d loss / d log_clean: clean bags push it up, toxic bags down
        d = np.where(y == 1, (1 - q) / q, -1.0)
        gz = np.where(up, -p * d[owner], 0.0)  # d log(1 - p) / d z = -p
        grad = np.append(np.bincount(flat, weights=gz[sent], minlength=features) / n + ridge * w, (gz.sum() + p0 * (d[owner] * up).sum() - p0 * d.sum()) / n)
        m1 = 0.9 * m1 + 0.1 * grad
        v1 = 0.999 * v1 + 0.001 * grad**2
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(v1 / (1 - 0.999**t)) + 1e-9)
        w -= step[:-1]
        b = min(b - step[-1], -4.0)
    return w, float(b), platt(np.log(q) - np.log1p(-q), y)


def fitted(documents: DataFrame, labels: DataFrame, rows: int = 16_000, features: int = 2000, least: int = 5) -> Scorer | None:
    """The model from at most `rows` labelled documents; None without both classes among them."""
    spark = tuned(documents.sparkSession)
    scratch = Scratch(spark, "toxicity")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    mine = docs.join(F.broadcast(marked(labels, "toxic", rows)), "doc_id")  # at most `rows` ids
    # a doc_id in several rows lends one of its texts, so that there are no more rows than ids
    train_docs = scratch.keep(mine.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "y", "t.text"), "sample")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct words of each document by class, added up over the partition."""
        got: list[dict[str, int]] = [{}, {}]
        n = [0, 0]
        for b in batches:
            for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                n[y] += 1
                mine = got[y]
                for w in {_OUTSIDE.sub("", x) for x in set(t.lower().split())}:
                    mine[w] = mine.get(w, 0) + 1
        all_ = sorted(got[0].keys() | got[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array([*all_, None], pa.string()), pa.array([*(got[0].get(w, 0) for w in all_), n[0]], pa.int64()), pa.array([*(got[1].get(w, 0) for w in all_), n[1]], pa.int64())], names=["word", "clean", "toxic"])

    counted = train_docs.select("text", "y").mapInArrow(words, schema_of("word string, clean long, toxic long")).groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = scratch.keep(counted, "words")
    total = counted.where("word is null").first()
    if not total or not total["clean"] or not total["toxic"]:
        return None

    marked_word = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    grams = F.array_union(
        F.array(F.concat(F.lit("="), F.col("word"))),
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked_word) - GRAM + 1)), lambda i: F.substr(marked_word, i, F.lit(GRAM))),
    )
    p1, p0 = (F.col("toxic") + 0.5) / (total["toxic"] + 1.0), (F.col("clean") + 0.5) / (total["clean"] + 1.0)
    strong = (
        counted.where("word is not null and word <> ''")
        .select(F.explode(grams).alias("feature"), "clean", "toxic")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= least)
        .withColumn("z", F.log(p1 / p0) / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)))
        .where((F.col("z") > 3) & (p1 / p0 >= RATIO))
    )
    names = sorted(r["feature"] for r in strong.orderBy(F.desc("z"), "feature").limit(features).collect())
    probe = spark.sparkContext.broadcast(names)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(probe.value, np.zeros(len(probe.value)), 0.0)
        for b in batches:
            got = [own.bag(t) for t in b.column("text").to_pylist()]
            sizes = [np.array([len(own_) for _, _, own_ in f], dtype=np.uint16).tobytes() for f in got]
            flat = [np.array([x for _, _, own_ in f for x in own_], dtype=np.uint16).tobytes() for f in got]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(sizes, pa.binary()), pa.array(flat, pa.binary())], names=["doc_id", "y", "sizes", "flat"])

    # at most `rows` rows, of feature numbers only, two bytes each
    got = train_docs.mapInArrow(bags, schema_of("doc_id long, y int, sizes binary, flat binary")).toPandas().sort_values(["doc_id", "y"], kind="stable")
    bag = Bags([np.frombuffer(x, dtype=np.uint16) for x in got["sizes"]], [np.frombuffer(x, dtype=np.uint16) for x in got["flat"]])
    return Scorer(names, *train(bag, got["y"].to_numpy(), len(names)))


def scored(documents: DataFrame, model: Scorer | None) -> DataFrame:
    """(doc_id, score, sentences array<struct<start, end, p>>) of every row; no shuffle."""
    spark = tuned(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = "array<struct<start:bigint,end:bigint,p:double>>"
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.array().cast(kind).alias("sentences"))
    names = sorted(model.at, key=model.at.get)
    shared = spark.sparkContext.broadcast((names, model.weight, model.bias, model.scale))
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for b in batches:
            got = [own.score(t) for t in b.column("text").to_pylist()]
            spans = [[{"start": s, "end": e, "p": p} for s, e, p in x] for _, x in got]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s for s, _ in got], pa.float64()), pa.array(spans, arrow)], names=["doc_id", "score", "sentences"])

    return docs.mapInArrow(run, schema_of(f"doc_id long, score double, sentences {kind}"))
