"""Quality classifier by co-training.

Two views of a document that share no measure: its content (hashed words and word pairs, how words
repeat, their shapes, which signs the text is made of), and its page's metadata (language, source,
length, line layout). A classifier for each view starts from the labelled sample. Every round each
one labels the unlabelled pool, and those it is most confident about, in the proportion of the
classes, go to the other's training rows with that pseudo-label. At the end both views are calibrated
on labelled rows that neither has learned from, and the calibrated logits are combined by a small
logistic regression; that scores all rows.

Fitting is bounded: at most `labelled` labelled documents and `pool` unlabelled ones (parameters),
one row each, chosen by a hash of doc_id. Features and scores cover every row and its whole text.
Labels of rows with crc32(doc_id as text) mod 5 = 0 are never used, so held-out accuracy can be measured.

Edge cases: null or empty text has features of an empty page; null lang or source is a value of its
own; without labels of both classes everything is kept with score 1; where too few labels are known to
keep some of both classes back, the views are calibrated on the rows they learned from; a doc_id that
is labelled twice has its more frequent label (1 at a tie), one in several rows lends one of them
(smallest hash of its text); each row gets a score; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, schema_of, text_blocks, tuned
from .learning import logistic, marked, platt, sampled, sigmoid

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER, _DIGITS, _SPACES, _STOPS = bytes(range(65, 91)), b"0123456789", b" \t\r\n", b".,;:!?'\"()-"
#: Buckets of hashed words, of hashed word pairs, of languages and of sources.
WORDS, PAIRS, LANGS, SOURCES = 96, 64, 8, 16
#: Measures of a view that bend, and all of its columns.
CONTENT, META = 18, 7
N_CONTENT, N_META = CONTENT + WORDS + PAIRS, META + LANGS + SOURCES
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def word_measures(text: str) -> list[float]:
    """How words repeat, their shapes, and the signs of the text."""
    raw = text.encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    left = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    letters, upper, digits, stops = left(_LETTERS), left(_UPPER), left(_DIGITS), left(_STOPS)
    signs = [letters, upper / letters if letters else 0.0, digits, stops, max(0.0, 1 - letters - digits - stops - left(_SPACES)), raw.count(b"!") / size]
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (CONTENT - len(signs) - 1) + [1.0] + signs
    counts = Counter(words)
    top = counts.most_common(3)
    plain = sum(map(str.isalpha, words))
    lengths = sum(map(len, words)) / n
    return [
        len(counts) / n,
        top[0][1] / n,
        sum(c for _, c in top) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalnum, words)) / n,
        plain / n,
        min(lengths, 40.0) / 10,
        abs(min(lengths, 40.0) - 5.5) / 10,
        np.log1p(n),
        sum(1 for c in counts.values() if c == 1) / n,
        0.0,
    ] + signs


def hashed_words(texts: pa.Array) -> np.ndarray:
    """Square roots of the shares of each text's words and word pairs by hash bucket."""
    out = np.zeros((len(texts), WORDS + PAIRS))
    for i, n, data, offsets in text_blocks(texts, 2 << 20):
        w = WordTable(data, offsets)
        count = np.diff(w.first)
        owner = np.repeat(np.arange(n), count)
        one = np.bincount(owner * WORDS + (w.hash >> np.uint64(20)).astype(np.int64) % WORDS, minlength=n * WORDS).reshape(n, WORDS)
        both = np.flatnonzero(owner[1:] == owner[:-1])
        pair = ((w.hash[both] * _PAIR + w.hash[both + 1]) >> np.uint64(20)).astype(np.int64) % PAIRS
        two = np.bincount(owner[both] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
        some = np.maximum(count, 1)[:, None]
        out[i : i + n] = np.sqrt(np.hstack([one / some, two / some]))
    return out


def meta_view(text: str, lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    lines = raw.split(b"\n")
    sizes = sorted(map(len, lines))
    out = [
        np.log1p(n_chars if n_chars is not None and n_chars >= 0 else len(text)),
        np.log1p(len(lines)),
        np.log1p(len(raw) / len(lines)),
        np.log1p(sizes[len(sizes) // 2]),
        np.log1p(sizes[-1]),
        1 - len(set(lines)) / len(lines),
        sum(n < 30 for n in sizes) / len(sizes),
    ]
    one = [0.0] * (LANGS + SOURCES)
    one[xxhash.xxh32_intdigest(f"l:{lang}") % LANGS] = 1.0
    one[LANGS + xxhash.xxh32_intdigest(f"s:{source}") % SOURCES] = 1.0
    return out + one


def _views(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = b.column("text")
    texts = [t or "" for t in column.to_pylist()]
    rest = [b.column(c).to_pylist() for c in ("lang", "source", "n_chars")]
    content = np.array([word_measures(t) for t in texts], dtype=np.float64).reshape(-1, CONTENT)
    meta = np.array([meta_view(t, *r) for t, *r in zip(texts, *rest, strict=True)], dtype=np.float64).reshape(-1, N_META)
    return np.hstack([content, hashed_words(column)]), meta


def _bent(x: np.ndarray, k: int) -> np.ndarray:
    """The first `k` columns with their squares and roots: thresholds bend a linear score."""
    return np.hstack([x, x[:, :k] ** 2, np.sqrt(np.abs(x[:, :k]))])


class Model:
    """Two views, calibrated and combined."""

    def __init__(self, content: np.ndarray, meta: np.ndarray, y: np.ndarray, known: np.ndarray, rounds: int, share: float):
        """y: labels, -1 where unknown; known: 0 pool, 1 learn, 2 calibrate."""
        views = [_bent(content, CONTENT), _bent(meta, META)]
        self.mean = [v.mean(axis=0, dtype=np.float64) for v in views]
        self.std = [v.std(axis=0, dtype=np.float64) + 1e-6 for v in views]
        for v, m, s in zip(views, self.mean, self.std, strict=True):
            v -= m.astype(v.dtype)
            v /= s.astype(v.dtype)
        learn, pool, hold = (np.flatnonzero(known == k) for k in (1, 0, 2))
        taught = [(learn, y[learn].astype(float)) for _ in views]  # rows and labels of each view
        rate = y[learn].mean()
        free = [np.ones(len(pool), dtype=bool) for _ in views]
        self.w = [logistic(v, t, np.ones(len(r)), rows=r) for v, (r, t) in zip(views, taught, strict=True)]
        self.exchanged = 0
        for _ in range(rounds if len(pool) else 0):
            give = []
            for k, v in enumerate(views):
                p = sigmoid(v[pool] @ self.w[k][:-1] + self.w[k][-1])
                room = free[1 - k]
                n = int(share * len(pool))
                up = np.argsort(-np.where(room, p, -1), kind="stable")[: int(n * rate)]
                down = np.argsort(np.where(room, p, 2), kind="stable")[: n - int(n * rate)]
                up, down = up[room[up] & (p[up] > 0.95)], down[room[down] & (p[down] < 0.05)]
                give.append((up, down))
            for k, (up, down) in enumerate(give):
                other = 1 - k
                free[other][up] = free[other][down] = False
                rows, t = taught[other]
                taught[other] = (np.concatenate([rows, pool[up], pool[down]]), np.concatenate([t, np.ones(len(up)), np.zeros(len(down))]))
                self.exchanged += len(up) + len(down)
            # a pseudo-label counts less than a label
            self.w = [logistic(v, t, np.where(np.arange(len(r)) < len(learn), 1.0, 0.5), rows=r) for v, (r, t) in zip(views, taught, strict=True)]
        raw = [v[hold] @ w[:-1] + w[-1] for v, w in zip(views, self.w, strict=True)]
        self.scale = [platt(z, y[hold]) for z in raw]
        calibrated = np.stack([a * z + b for z, (a, b) in zip(raw, self.scale, strict=True)], axis=1)
        self.join = logistic(np.clip(calibrated, -12, 12), y[hold].astype(float), np.ones(len(hold)), ridge=0.1)

    def scores(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(content, metadata, combined) probabilities of good quality."""
        z = []
        for x, k, m, s, w, (a, b) in zip((content, meta), (CONTENT, META), self.mean, self.std, self.w, self.scale, strict=True):
            z.append(np.clip(a * (((_bent(x, k) - m) / s) @ w[:-1] + w[-1]) + b, -12, 12))
        return sigmoid(z[0]), sigmoid(z[1]), sigmoid(np.stack(z, axis=1) @ self.join[:-1] + self.join[-1])


def fitted(documents: DataFrame, labels: DataFrame, labelled: int = 12_000, pool: int = 12_000, rounds: int = 4, share: float = 0.1) -> Model | None:
    """The model from at most `labelled` + `pool` documents; None without labels of both classes."""
    tuned(documents.sparkSession)
    known_ids = marked(labels, "quality", labelled)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("long").alias("n_chars"))
    others = docs.where("doc_id is not null").select("doc_id").distinct().join(F.broadcast(known_ids.select("doc_id")), "doc_id", "left_anti")
    chosen = F.broadcast(known_ids.union(sampled(others, pool).select("doc_id", F.lit(-1).alias("y"))))  # at most labelled + pool ids

    def views(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = np.hstack(_views(b)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), b.column("h"), pa.array([r.tobytes() for r in both], pa.binary())], names=["doc_id", "y", "h", "x"])

    seen = docs.join(chosen, "doc_id").withColumn("h", F.xxhash64("text", "lang", "source", "n_chars")).mapInArrow(views, schema_of("doc_id long, y int, h long, x binary"))
    # a doc_id in several rows lends one of them, so that no more rows than ids come to the driver
    rows = seen.groupBy("doc_id", "y").agg(F.min(F.struct("h", "x")).alias("r")).select("doc_id", "y", "r.x").toPandas().sort_values(["doc_id", "y"], kind="stable")
    y = rows["y"].to_numpy()
    if len(set(y[y >= 0])) < 2:
        return None
    x = np.frombuffer(b"".join(rows.pop("x")), dtype=np.float32).reshape(len(y), -1)
    known = np.where(y < 0, 0, np.where(np.arange(len(y)) % 4 == 3, 2, 1))
    for k in (1, 2):
        if len(set(y[known == k])) < 2:
            known = np.where(y < 0, 0, 1)
    if not (known == 2).any():  # too few labels to keep some back
        both = np.flatnonzero(known == 1)
        x, y, known = np.vstack([x, x[both]]), np.concatenate([y, y[both]]), np.concatenate([known, np.full(len(both), 2)])
    return Model(x[:, :N_CONTENT], x[:, N_CONTENT:], y, known, rounds, share)


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """`documents` with content_score, meta_score and quality_score; no shuffle."""
    spark = tuned(documents.sparkSession)
    names = ("content_score", "meta_score", "quality_score")
    base = documents.drop(*names)
    if model is None:
        return base.select("*", *[F.lit(1.0).alias(n) for n in names])
    shared = spark.sparkContext.broadcast(model)
    ddl = ", ".join(f"{n} double" for n in names)
    out = schema_of(ddl)
    for f in reversed(base.schema.fields):
        out.fields.insert(0, f)
        out.names.insert(0, f.name)
    cast = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    for c in cast:
        if c not in base.columns:
            raise ValueError(f"documents need a column {c}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = shared.value.scores(*_views(b))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(g, pa.float64()) for g in got]], names=[*b.schema.names, *names])

    return base.mapInArrow(run, out)
