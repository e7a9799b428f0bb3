"""Benchmark passages in documents, found in a latent semantic space.

1. Documents are cut into overlapping passages (`size` words, one every `stride`), and so are the
   benchmark items. The document frequency of every benchmark term is counted over all passages.
2. The TF-IDF space has the terms that tell items apart: of each item passage the rarer half of its
   terms, four at least. Corpus passages with `least` of them or more have a vector worth a search;
   all others are (nearly) zero in this space. They are kept with their surroundings as term ids.
3. A randomised SVD of the TF-IDF matrix of all these passages, with power iterations: partial
   products A'(A Omega) are added up over the partitions. The item passages are rows as well, and
   count as much as the corpus does as a whole (equal sums of squares). `RANK` directions are kept.
4. Items are the stated queries, passages are scored in blocks: pairs with a latent cosine of
   `cosine` or more are candidates.
5. A candidate is confirmed by the longest common subsequence of item passage and surroundings, as a
   share of the item's words: from `sure` on it alone decides; from `lcs` on the item's answer has to
   be there too, if it has one; from `loose` on only where it has one and that is there. An answer is
   the column `answer`, or what follows "answer:" in the item's text. Words that only answers have are
   terms as well, but never tell items apart.

The corpus is read twice (frequencies, passages) however many items there are. Terms beyond `SPACE`
share dimensions of the latent space, so its matrices have at most SPACE x RANK numbers; item lists
grow with the benchmark alone, which is a table that fits the driver.

Edge cases: null or blank text, and text without words: no passage, clean; such items are never found;
null item_id: found, but not named in item_ids; item ids of any type keep it; items of fewer than `least`
words are searched as they are; repeated documents each get a row, and rows with one doc_id share
their verdict; a null doc_id is kept, and clean (a row without a name can't be joined: give rows
numbers, as the pipeline does); an empty benchmark leaves all clean; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordTable, schema_of, text_blocks, tuned

#: Dimensions of the TF-IDF space at most, and of the latent space.
SPACE, RANK = 1 << 15, 256
#: Item passages that a block of corpus passages is scored with at a time.
ITEM_BLOCK = 4096
#: Lots of terms whose partial products are added up side by side.
SUMS = 48


class TermIds:
    """Numbers of known 64-bit word hashes: a table by low bits, checked on all bits."""

    def __init__(self, hashes: np.ndarray):
        self.known = hashes
        bits = max(10, int(np.ceil(np.log2(max(2, len(hashes))))) + 4)
        while True:
            low = hashes & np.uint64((1 << bits) - 1)
            if len(np.unique(low)) == len(hashes) or bits >= 26:
                break
            bits += 1
        self.mask = np.uint64((1 << bits) - 1)
        self.at = np.full(1 << bits, -1, dtype=np.int32)
        self.at[low] = np.arange(len(hashes), dtype=np.int32)
        # the few that share low bits with another are searched in order
        self.order = np.argsort(hashes)
        self.clash = len(np.unique(low)) < len(hashes)

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h), -1, dtype=np.int32)
        got = self.at[h & self.mask]
        ok = (got >= 0) & (self.known[np.maximum(got, 0)] == h)
        out = np.where(ok, got, -1).astype(np.int32)
        if self.clash:
            ask = np.flatnonzero(~ok & (got >= 0))
            pos = np.minimum(np.searchsorted(self.known, h[ask], sorter=self.order), len(self.known) - 1)
            hit = self.order[pos]
            out[ask] = np.where(self.known[hit] == h[ask], hit, -1)
        return out


def starts_of(words: int, size: int, stride: int) -> range:
    """First words of the passages of a text."""
    return range(0, max(1, words - (size - stride)), stride) if words else range(0)


def _passages(first: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end) of all passages of a batch."""
    count = np.diff(first)
    n = np.where(count > 0, np.maximum(1, -(-(count - (size - stride)) // stride)), 0)
    text = np.repeat(np.arange(len(count)), n)
    k = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
    lo = first[:-1][text] + k * stride
    return text, lo, np.minimum(lo + size, first[1:][text])


def _hits(term: np.ndarray, lo: np.ndarray, hi: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (passage, term) pairs: every occurrence lies in few passages, found from the passages' sorted bounds."""
    at = np.flatnonzero(term >= 0)
    a = np.searchsorted(hi, at, side="right")  # first passage that ends after it
    b = np.searchsorted(lo, at, side="right")  # passages that begin up to it
    n = np.maximum(b - a, 0)
    occ = np.repeat(at, n)
    p = np.arange(len(occ)) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.repeat(a, n)
    key = np.unique(p.astype(np.int64) * terms + term[occ])
    return key // terms, (key % terms).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch], hashes: np.ndarray, size: int, stride: int) -> Iterator[pa.RecordBatch]:
    ids = TermIds(hashes)
    df = np.zeros(len(hashes), dtype=np.int64)
    total = 0
    for batch in batches:
        for _, _, data, offsets in text_blocks(batch.column("text"), 1 << 20):
            w = WordTable(data, offsets, marks=False)
            _, lo, hi = _passages(w.first, size, stride)
            total += len(lo)
            _, t = _hits(ids.of(w.hash), lo, hi, len(hashes))
            df += np.bincount(t, minlength=len(hashes))
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int64()), pa.array(np.append(df[some], total), pa.int64())], names=["term", "n"])


def _selected(batches: Iterator[pa.RecordBatch], hashes: np.ndarray, place: np.ndarray, size: int, stride: int, least: int) -> Iterator[pa.RecordBatch]:
    """Passages with `least` anchor terms or more: row id, anchors' places in the space, and the term ids around them."""
    ids, n_terms = TermIds(hashes), len(hashes)
    for batch in batches:
        for i, _, data, offsets in text_blocks(batch.column("text"), 1 << 20):
            w = WordTable(data, offsets, marks=False)
            text, lo, hi = _passages(w.first, size, stride)
            term = ids.of(w.hash)
            rare = np.where((term >= 0) & (place[np.maximum(term, 0)] >= 0), term, -1)
            p, t = _hits(rare, lo, hi, n_terms)
            if not len(p):
                continue
            which, start, n = np.unique(p, return_index=True, return_counts=True)
            good = n >= least
            which, start, n = which[good], start[good], n[good]
            if not len(which):
                continue
            doc = batch.column("rid").slice(i).take(pa.array(text[which]))
            near_lo = np.maximum(lo[which] - size // 2, w.first[text[which]])
            near_hi = np.minimum(hi[which] + size // 2, w.first[text[which] + 1])
            anchors = [place[t[s : s + m]] for s, m in zip(start, n, strict=True)]
            near = [term[a:b] for a, b in zip(near_lo, near_hi, strict=True)]
            yield pa.RecordBatch.from_arrays([doc, _lists(anchors, np.int32), _lists(near, np.int32)], names=["rid", "anchors", "near"])


def _lists(rows: list[np.ndarray], kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).astype(kind) if rows else np.zeros(0, kind)))


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    off = column.offsets.to_numpy()
    return flat, off - off[0]


def _segment_sums(rows: np.ndarray, pick: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of rows[pick[start:start + size]] for each segment of one pick or more, longest first, a pick of all segments at a time."""
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    out = rows[pick[start]]
    for k in range(1, int(size[0]) if len(size) else 0):
        m = int(np.searchsorted(-size, -k, side="left"))
        out[:m] += rows[pick[start[:m] + k]]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def _embedded(flat: np.ndarray, off: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Sums of the rows of `base` that each passage's terms name."""
    return _segment_sums(base, flat, off[:-1], np.diff(off))


def _by_term(term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, distinct terms, first place of each in the order, number of places)."""
    order = np.argsort(term, kind="stable")
    t, start, n = np.unique(term[order], return_index=True, return_counts=True)
    return order, t, start, n


def _gram(flat: np.ndarray, off: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A'(A base) of passages given as lists of places: (places that occur, their rows)."""
    order, t, start, n = _by_term(flat)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return t, _segment_sums(_embedded(flat, off, base), owner[order], start, n)


def _product(batches: Iterator[pa.RecordBatch], base: np.ndarray) -> Iterator[pa.RecordBatch]:
    """This partition's part of A'(A base), as rows by place."""
    out = np.zeros(base.shape, dtype=np.float64)
    for b in batches:
        t, rows = _gram(*_rows(b.column("anchors")), base)
        out[t] += rows
    some = np.flatnonzero(np.any(out != 0, axis=1))
    rows = [r.tobytes() for r in out[some].astype(np.float32)]
    yield pa.RecordBatch.from_arrays([pa.array(some % SUMS, pa.int64()), pa.array(some, pa.int64()), pa.array(rows, pa.binary())], names=["lot", "term", "row"])


def _added(table: pa.Table) -> pa.Table:
    """Rows of one lot of terms added up by term."""
    row = np.stack([np.frombuffer(r.as_buffer(), dtype=np.float32) for r in table.column("row")]).astype(np.float64)
    order, t, start, n = _by_term(table.column("term").to_numpy())
    out = _segment_sums(row, order, start, n).astype(np.float32)
    return pa.table({"term": pa.array(t, pa.int64()), "row": pa.array([r.tobytes() for r in out], pa.binary())})


def _times(passages: DataFrame, scaled: np.ndarray) -> np.ndarray:
    """A'(A x) over all corpus passages."""
    base = passages.sparkSession.sparkContext.broadcast(scaled.astype(np.float32))
    parts = passages.select("anchors").mapInArrow(lambda it: _product(it, base.value), schema_of("lot long, term long, row binary"))
    out = np.zeros(scaled.shape)
    for r in parts.groupBy("lot").applyInArrow(_added, schema_of("term long, row binary")).collect():  # at most SPACE x RANK numbers
        out[r["term"]] = np.frombuffer(r["row"], dtype=np.float32)
    return out


def lcs_length(a: list[int], b: np.ndarray) -> int:
    """Longest common subsequence, a machine word of item positions at a time; -1 matches nothing."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b.tolist():
        m = where.get(y, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


#: Candidates whose surroundings are looked at side by side.
SIDE_BY_SIDE = 8192


def _inside(item: np.ndarray, term: np.ndarray, member: np.ndarray, terms: int) -> np.ndarray:
    """Whether a term is one of an item passage's: `member` has the sorted keys passage * terms + term."""
    key = item * terms + term
    at = np.minimum(np.searchsorted(member, key), len(member) - 1)
    return (member[at] == key) & (term >= 0)


def _reachable(row: np.ndarray, item: np.ndarray, near: np.ndarray, noff: np.ndarray, member: np.ndarray, terms: int, words: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Whether enough words around a candidate are the item's: a common subsequence has no other words."""
    out = np.zeros(len(row), dtype=bool)
    for at in range(0, len(row), SIDE_BY_SIDE):
        r, i = row[at : at + SIDE_BY_SIDE], item[at : at + SIDE_BY_SIDE]
        n = noff[r + 1] - noff[r]
        which = np.repeat(np.arange(len(r)), n)
        place = np.arange(len(which)) + np.repeat(noff[r] - (np.cumsum(n) - n), n)
        inside = _inside(i[which], near[place], member, terms)
        out[at : at + SIDE_BY_SIDE] = np.bincount(which[inside], minlength=len(r)) / words[i] >= share[at : at + SIDE_BY_SIDE]
    return out


_ANSWER = re.compile(r"\banswer\s*:\s*", re.IGNORECASE)


def _word_hashes(text: str | None) -> np.ndarray:
    if not text:
        return np.zeros(0, dtype=np.uint64)
    _, _, data, offsets = next(iter(text_blocks(pa.array([text], pa.large_string()), 1 << 40)))
    return WordTable(data, offsets, marks=False).hash


def item_passages(benchmark: DataFrame, size: int, stride: int) -> tuple[DataFrame, list[tuple[int, np.ndarray, np.ndarray]]]:
    """((nth, item_id), [(nth, word hashes, word hashes of the answer)]) of the items that have words."""
    answered = "answer" in benchmark.columns
    names, passages = [], []
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"), (F.col("answer") if answered else F.lit(None)).cast("string").alias("answer")).where("text is not null")
    for r in rows.orderBy("item_id", "text", "answer").toLocalIterator():
        text, answer = r["text"], r["answer"]
        if not answered:
            text, *told = _ANSWER.split(text, maxsplit=1)
            answer = told[0] if told else None
        words, last = _word_hashes(text), _word_hashes(answer)
        for k in starts_of(len(words), size, stride):
            passages.append((len(names), words[k : k + size], last))
        if len(words):
            names.append((len(names), r["item_id"]))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.sparkSession.createDataFrame(names, f"nth long, item_id {kind}"), passages


def contaminated(documents: DataFrame, benchmark: DataFrame, size: int = 64, stride: int = 32, cosine: float = 0.3, lcs: float = 0.7, least: int = 3, iterations: int = 1, sure: float = 0.9, loose: float = 0.5) -> DataFrame:
    """(doc_id, contaminated, item_ids, best_lcs), one row for each document."""
    spark = tuned(documents.sparkSession)
    scratch = Scratch(spark, "decontam")
    kind = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select(F.col("doc_id").alias("rid"), F.col("text").cast("string").alias("text"))
    names, passages = item_passages(benchmark, size, stride)
    ids, none = documents.select("doc_id"), F.array().cast(f"array<{names.schema['item_id'].dataType.simpleString()}>")
    if not passages:
        return ids.select("doc_id", F.lit(False).alias("contaminated"), none.alias("item_ids"), F.lit(0.0).alias("best_lcs"))
    hits = _search(docs, passages, scratch, kind, size, stride, cosine, (loose, lcs, sure), least, iterations)
    per = hits.join(F.broadcast(names), "nth").groupBy("rid").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("lcs").alias("best_lcs"))
    out = ids.join(per.withColumnRenamed("rid", "doc_id"), "doc_id", "left")
    return out.select("doc_id", F.col("best_lcs").isNotNull().alias("contaminated"), F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("best_lcs", F.lit(0.0)).alias("best_lcs"))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)


def _search(docs: DataFrame, passages: list[tuple[int, np.ndarray, np.ndarray]], scratch: Scratch, kind: str, size: int, stride: int, cosine: float, shares: tuple[float, float, float], least: int, iterations: int) -> DataFrame:
    """(rid, nth, lcs) of the confirmed candidates."""
    spark = docs.sparkSession
    hashes = np.unique(np.concatenate([*[w for _, w, _ in passages], *[a for _, _, a in passages]]))
    pieces = [(nth, np.searchsorted(hashes, w), np.searchsorted(hashes, a).tolist()) for nth, w, a in passages]
    known = spark.sparkContext.broadcast(hashes)  # the benchmark's terms
    freq = docs.select("text").mapInArrow(lambda it: _frequencies(it, known.value, size, stride), schema_of("term long, n long")).groupBy("term").agg(F.sum("n").alias("n"))
    df, total = np.zeros(len(hashes)), 1
    for r in freq.collect():  # a row a benchmark term
        if r["term"] < 0:
            total = max(1, r["n"])
        else:
            df[r["term"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1e-3  # a term that every passage has still has a direction
    anchor = np.zeros(len(hashes), dtype=bool)
    for _, seq, _ in pieces:
        t = np.unique(seq)
        anchor[t[np.argsort(-idf[t], kind="stable")][: max(4, (len(t) + 1) // 2)]] = True
    own = [(lambda t: t[anchor[t]])(np.unique(seq)) for _, seq, _ in pieces]
    need = min(least, min(len(t) for t in own))
    dims = min(int(anchor.sum()), SPACE)
    place = np.where(anchor, (np.cumsum(anchor) - 1) % dims, -1).astype(np.int32)
    kept = scratch.keep(
        docs.mapInArrow(lambda it: _selected(it, known.value, place, size, stride, need), schema_of(f"rid {kind}, anchors array<int>, near array<int>")),
        "passages",
    )
    # the latent space: raw counts meet A = counts * idf, so idf is folded into the test matrix on both sides
    weight = np.zeros((dims, 1))
    np.maximum.at(weight[:, 0], place[anchor], idf[anchor])
    items, ioff = _flat([place[t] for t in own])
    mass = float((df[anchor] * idf[anchor] ** 2).sum()) / float((weight[items] ** 2).sum())  # items weigh what the corpus weighs
    rank = min(dims, RANK)
    basis = np.random.Generator(np.random.PCG64(8)).standard_normal((dims, rank))
    for _ in range(1 + iterations):
        got = _times(kept, weight * basis)
        t, rows = _gram(items, ioff, weight * basis)
        got[t] += max(mass, 1.0) * rows
        basis, _ = np.linalg.qr(weight * got)
    ask = _unit(_embedded(items, ioff, weight * basis))
    model = spark.sparkContext.broadcast(((weight * basis).astype(np.float32), ask.astype(np.float32), pieces, len(hashes)))
    loose, lcs, sure = shares

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, ask, pieces, terms = model.value
        member = np.unique(np.concatenate([i * terms + seq for i, (_, seq, _) in enumerate(pieces)]))
        words = np.array([len(seq) for _, seq, _ in pieces])
        floor = np.array([loose if answer else lcs for _, _, answer in pieces])
        for b in batches:
            flat, off = _rows(b.column("anchors"))
            z = _unit(_embedded(flat, off, base))
            near, noff = _rows(b.column("near"))
            near = near.astype(np.int64)
            out: list[tuple[int, int, float]] = []
            for at in range(0, len(z), 1024):
                for first in range(0, len(ask), ITEM_BLOCK):
                    p, i = np.nonzero(z[at : at + 1024] @ ask[first : first + ITEM_BLOCK].T >= cosine)
                    p, i = p + at, i + first
                    some = _reachable(p, i, near, noff, member, terms, words, floor[i])
                    for row, item in zip(p[some].tolist(), i[some].tolist(), strict=True):
                        nth, seq, answer = pieces[item]
                        around = near[noff[row] : noff[row + 1]]
                        share = lcs_length(seq.tolist(), around[_inside(np.full(len(around), item), around, member, terms)]) / len(seq)
                        if share >= sure or share >= floor[item] and (not answer or lcs_length(answer, around) == len(answer)):
                            out.append((row, nth, share))
            pick = pa.array([r for r, _, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("rid").take(pick), pa.array([i for _, i, _ in out], pa.int64()), pa.array([s for _, _, s in out], pa.float64())], names=["rid", "nth", "lcs"])

    return kept.mapInArrow(confirm, schema_of(f"rid {kind}, nth long, lcs double"))
