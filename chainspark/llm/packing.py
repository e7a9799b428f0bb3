"""Sequences of fixed length with a controlled mixture of sources.

Deficit round-robin over one queue a source: a window of `window_sequences` sequences gives each
queue a credit of its target share; a queue sends as many of its next tokens as its credit allows,
cutting a document where the credit ends, and carries what is left (under one token) into the next
window. A queue whose share of a window is under `GRAIN` tokens would be cut to crumbs: it saves its
credit up and sends `GRAIN` tokens at a time, each such queue from a phase of its own. So a window has
its target of every queue within one token, or within `GRAIN` tokens of those small queues, while
queues last; queues with nothing left hand their share to the others in proportion, and windows stay
full but for those same roundings.

Credit only adds up, so what a queue has sent by the end of window k is a formula of k, and the window
of a token follows from its place in its queue: no loop over windows. That place is a running sum in
each queue; a second running sum over (window, queue, document) gives places in the packed stream,
which is cut every `length` ids.

Targets default to each source's share of all tokens, so the mixture of the corpus holds in every
window from first to last; `weights` sets others (None names the rows without a source; sources
that it lacks come last).

Every source is a queue, however many there are: their sizes are a table. A document's running sum
crosses partitions by totals of key ranges (a very frequent doc_id is dealt by row number as well), so
neither a hot source nor a long queue meets in one task. With `weights`, what all queues have sent by
a time is a running sum over the times at which they end, and the times at which windows end are one
over what had been sent by then. Ids move once, to be cut beside their places.

Edge cases: null text: only the end id; null source: a queue of its own; null doc_id: first in its
queue; repeated rows are packed once each; an empty table gives no pieces; extra columns are
ignored. Only the last sequence may be short; it is padded to `length` unless its size is a power
of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, key_cuts, key_parts, ordered_prefix, range_of, schema_of, tasks, tuned
from .tokens import tokenised

#: Of so many queues or more, a window is summed by ranges of sources, cut at names of a sample.
SPAN_QUEUES, SPAN_SAMPLE = 64, 4096
#: Tokens that a queue sends at least, if its share of a window is less.
GRAIN = 64
#: Windows summed together in the second running sum.
WINDOW_GROUP = 4


def packed(documents: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, window_sequences: int = 64, weights: dict[str | None, float] | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces (doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, ids).

    Without `with_ids` the column ids is null: for reports, which need places and checksums only.
    """
    spark = tuned(documents.sparkSession)
    scratch = Scratch(spark, "packing")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    coded, width = tokenised(rows, tokenizer, end_id, ["doc_id", "source"])
    coded = scratch.keep(coded.withColumn("rid", F.monotonically_increasing_id()), "tokens")
    pieces = placed(coded.select("rid", "doc_id", "source", "n_tokens"), length * window_sequences, weights)
    places = pieces.groupBy("rid").agg(F.collect_list(F.struct("start", "n", "at", "window")).alias("pieces"))
    joined = coded.select("rid", "doc_id", "source", "n_tokens", "ids").join(places, "rid")
    ddl = "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long, ids binary"
    return joined.select("doc_id", "source", "n_tokens", "ids", "pieces").mapInArrow(lambda it: _cut(it, length, width, with_ids), schema_of(ddl))


def placed(tokens: DataFrame, window: int, weights: dict[str | None, float] | None = None) -> DataFrame:
    """(rid, doc_id, start, n, window, at): the `n` ids from `start` on that a row sends in a window, and the number of ids before them in the packed stream."""
    spark = tokens.sparkSession
    scratch = Scratch(spark, "queues")
    queue = ["named", "queue"]  # no source is a queue of its own, before the empty name
    rows = tokens.select("rid", "doc_id", "n_tokens", F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("queue"))
    sizes = scratch.keep(rows.groupBy(*queue).agg(F.sum("n_tokens").alias("queue_total")), "sizes")
    total, n = sizes.agg(F.sum("queue_total"), F.count("*")).first()
    if not n:
        return spark.createDataFrame([], "rid long, doc_id long, start long, n long, window long, at long")
    names = _name_cuts(sizes, n, 4 * tasks(spark, 8))
    if names:
        sizes = sizes.withColumn("span", F.size(F.filter(F.array(*map(F.lit, names)), lambda x: x < F.col("queue"))).cast("long"))
    if weights:
        sizes = _weighted(sizes, weights)
        share = F.col("w").cast("double") / float(sizes.agg(F.sum("w")).first()[0])
    else:
        share = F.col("queue_total").cast("double") / total
    sizes = sizes.withColumn("quantum", share * window).withColumn("grain", F.when(F.col("quantum") < GRAIN, GRAIN).otherwise(1).cast("long"))
    phase = F.pmod(F.xxhash64(*queue), F.lit(1 << 20)).cast("double") / (1 << 20) * F.col("grain")
    sizes = scratch.keep(sizes.withColumn("phase", F.when(F.col("grain") > 1, phase).otherwise(F.lit(0.0))), "queues")
    cuts = key_cuts(tokens.select("doc_id"), "doc_id", 4 * tasks(spark, 8))
    rows = rows.withColumn("part", key_parts("doc_id", cuts, F.shiftright("rid", 33) % (1 << 20)))
    w = Window.partitionBy(*queue, "part").orderBy("doc_id", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(*queue, "part").agg(F.sum("n_tokens").alias("n"))
    w_part = Window.partitionBy(*queue).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a key range
    starts = totals.select(*queue, "part", F.coalesce(F.sum("n").over(w_part), F.lit(0)).alias("start"))
    rows = rows.withColumn("inside", F.sum("n_tokens").over(w)).join(starts, [*queue, "part"]).join(sizes, queue)
    rows = rows.withColumn("end", F.col("start") + F.col("inside")).withColumn("begin", F.col("end") - F.col("n_tokens")).drop("start", "inside")
    windows = -(-total // window)
    pieces = _by_weights(rows, sizes, window, windows, scratch) if weights else _by_size(rows, windows)
    pieces = pieces.where("lo < hi").select("rid", "doc_id", *queue, *(["span"] if names else []), "window", (F.col("lo") - F.col("begin")).alias("start"), (F.col("hi") - F.col("lo")).alias("n"))
    spans = len(names) + 1
    group = F.col("window") * spans + F.col("span") if names else F.floor(F.col("window") / WINDOW_GROUP)
    out = ordered_prefix(pieces.withColumn("group", group.cast("long")), "group", ["window", *queue, "doc_id", "rid", "start"], ["n"], groups=windows * spans + 1)
    return out.select("rid", "doc_id", "start", "n", "window", F.col("n_before").cast("long").alias("at"))


def _credit(sent: Column) -> Column:
    """Tokens of a queue that its credit has paid for, in whole grains."""
    return (F.floor((sent + F.col("phase")) / F.col("grain") + 1e-9) * F.col("grain")).cast("long")


def _needed(place: Column) -> Column:
    """The credit at which the token at `place` goes: all of its grain has to be paid."""
    return (F.floor(place / F.col("grain")) + 1) * F.col("grain") - F.col("phase")


def _clipped(bound: Column) -> Column:
    return F.greatest(F.col("begin"), F.least(F.col("end"), bound))


def _by_size(rows: DataFrame, windows: int) -> DataFrame:
    """Rows cut where windows end (lo, hi: places in the queue), credit by shares of all tokens."""
    sent = lambda k: _credit(k * F.col("quantum"))

    def window_of(place: Column) -> Column:
        m = F.greatest(F.lit(1), F.ceil(_needed(place) / F.col("quantum"))).cast("long")
        exact = F.when(sent(m) <= place, m + 1).when(sent(m - 1) > place, m - 1).otherwise(m)  # where doubles round
        return F.least(F.greatest(exact, F.lit(1)), F.lit(windows)) - 1

    # a queue with grains sends each of them whole, in one window: as many rows as grains, not windows
    small = F.col("grain") > 1
    grain = lambda place: F.floor(place / F.col("grain")).cast("long")
    rows = rows.withColumn("w0", window_of(F.col("begin"))).withColumn("w1", F.greatest("w0", window_of(F.col("end") - 1)))
    rows = rows.select("*", F.explode(F.sequence(F.when(small, grain(F.col("begin"))).otherwise(F.col("w0")), F.when(small, grain(F.col("end") - 1)).otherwise(F.col("w1")))).alias("step"))
    first = F.col("step") * F.col("grain")
    lo = F.when(small, F.greatest("begin", first)).when(F.col("step") == F.col("w0"), F.col("begin")).otherwise(_clipped(sent(F.col("step"))))
    hi = F.when(small, F.least("end", first + F.col("grain"))).when(F.col("step") >= F.col("w1"), F.col("end")).otherwise(_clipped(sent(F.col("step") + 1)))
    return rows.select("*", F.when(small, window_of(first)).otherwise(F.col("step")).alias("window"), lo.alias("lo"), hi.alias("hi"))


def _by_weights(rows: DataFrame, sizes: DataFrame, window: int, windows: int, scratch: Scratch) -> DataFrame:
    """As `_by_size`, credit by weights: a queue has w * time until it ends, and window k ends at the time by which all have sent k windows."""
    spark = rows.sparkSession
    w = F.col("w").cast("double")
    # a queue with grains sends each of them whole: its rows are cut at grains, pieces of one window meet again below
    small, g = F.col("grain") > 1, F.col("g") * F.col("grain")
    steps = F.when(small, F.sequence(F.floor(F.col("begin") / F.col("grain")), F.floor((F.col("end") - 1) / F.col("grain")))).otherwise(F.array(F.lit(0).cast("long")))
    same = [c for c in rows.columns if c not in ("begin", "end")]
    rows = rows.select("*", F.explode(steps).alias("g")).select(*same, F.col("begin").alias("head"), F.when(small, F.greatest("begin", g)).otherwise(F.col("begin")).alias("begin"), F.when(small, F.least("end", g + F.col("grain"))).otherwise(F.col("end")).alias("end"))
    rows = scratch.keep(rows.withColumn("t0", _needed(F.col("begin")) / w).withColumn("t1", _needed(F.col("end") - 1) / w), "timed")
    ends = sizes.select((F.col("queue_total") / w).alias("time"), F.col("queue_total").alias("t"), "w")
    weight = ends.agg(F.sum("w")).first()[0]
    going = lambda: (F.lit(weight) - F.col("w_before") - F.col("w")).cast("double")
    times = rows.select(F.col("t0").alias("time")).union(rows.select("t1")).union(ends.select("time"))
    sent = _summed(times, ends, "time").select("time", ((F.col("t_before") + F.col("t")).cast("double") + going() * F.col("time")).alias("sent"))
    sent = scratch.keep(sent, "sent")
    k = lambda c: (F.least(F.lit(windows), F.greatest(F.lit(1), F.ceil(F.col(c) / window))) - 1).cast("long")
    for i in "01":
        rows = rows.join(sent.select(F.col("time").alias(f"t{i}"), F.col("sent").alias(f"s{i}")), f"t{i}").withColumn(f"w{i}", k(f"s{i}"))
    rows = rows.withColumn("w1", F.greatest("w0", "w1"))
    one = rows.where("w0 = w1").select("*", F.col("w0").alias("window"), F.col("begin").alias("lo"), F.col("end").alias("hi"))
    # the times at which windows end, from what the queues had sent when they ended
    done = ends.join(sent, "time").select("sent", "t", "w")
    marks = spark.range(1, windows + 1).select((F.col("id") * window).cast("double").alias("sent"), F.col("id").alias("k"))
    before = _summed(marks.select("sent"), done, "sent")
    left = F.greatest(F.lit(1e-18), (F.lit(weight) - F.col("w_before")).cast("double"))
    marks = scratch.keep(marks.join(before, "sent").select("k", ((F.col("sent") - F.col("t_before").cast("double")) / left).alias("time")), "windows")
    many = rows.where("w0 < w1").select("*", F.explode(F.sequence("w0", "w1")).alias("window"))
    many = many.join(marks.select(F.col("k").alias("window"), F.col("time").alias("from")), "window", "left").join(marks.select((F.col("k") - 1).alias("window"), F.col("time").alias("to")), "window", "left")
    lo = F.when(F.col("window") == F.col("w0"), F.col("begin")).otherwise(_clipped(_credit(F.col("from") * w)))
    hi = F.when(F.col("window") == F.col("w1"), F.col("end")).otherwise(_clipped(_credit(F.col("to") * w)))
    many = many.withColumn("lo", lo).withColumn("hi", hi)
    out = one.unionByName(many.select(*one.columns)).withColumn("begin", F.col("head"))
    of = [*same, "begin", "window"]
    return out.where(~small).select(*of, "lo", "hi").unionByName(out.where(small).groupBy(*of).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def _summed(points: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """For each distinct value of `key`: t and w of the `ends` there, and t_before, w_before of all lower ones."""
    spark = points.sparkSession
    none = F.lit(0).cast("decimal(27,18)")
    both = points.select(key, F.lit(0).cast("long").alias("t"), none.alias("w")).union(ends.select(key, "t", F.col("w").cast("decimal(27,18)"))).groupBy(key).agg(F.sum("t").alias("t"), F.sum("w").alias("w"))
    top = both.agg(F.max(key)).first()[0]
    both = both.withColumn("place", F.floor(F.col(key) / F.lit(float(top) or 1.0) * F.lit(float(1 << 50))).cast("long"))
    cuts = key_cuts(both, "place", 4 * tasks(spark, 8))
    return ordered_prefix(both.withColumn("part", range_of("place", cuts).cast("long")), "part", [key], ["t", "w"], groups=len(cuts) + 1)


def _name_cuts(sizes: DataFrame, n: int, most: int) -> list[str]:
    """Ascending names that cut the queues into about even ranges, none for few queues."""
    spans = min(most, n // SPAN_QUEUES)
    if spans < 2:
        return []
    some = sorted({r["queue"] for r in sizes.orderBy(F.xxhash64("queue"), "queue").limit(SPAN_SAMPLE).select("queue").collect()})
    return sorted({some[i * len(some) // spans] for i in range(1, spans)})


def _weighted(sizes: DataFrame, weights: dict[str | None, float]) -> DataFrame:
    """`sizes` with each queue's weight w, decimal so that sums don't depend on their order."""
    top = max(map(float, weights.values()), default=0.0)
    shift = -Decimal(repr(top)).adjusted() if top > 0 else 0
    exact = [(q is not None, q or "", Decimal(repr(float(x))).scaleb(shift).quantize(Decimal("1e-18"))) for q, x in weights.items() if x and x > 0]
    given = sizes.sparkSession.createDataFrame(exact, "named boolean, queue string, w decimal(27,18)")  # a parameter
    sizes = sizes.join(F.broadcast(given), ["named", "queue"], "left")
    low = sizes.where("w > 0").agg(F.min("w")).first()[0]
    least = max(Decimal("1e-18"), ((low if low is not None else Decimal(1)) / 10**6).quantize(Decimal("1e-18")))
    return sizes.withColumn("w", F.when(F.col("w") > 0, F.col("w")).otherwise(F.lit(least)).cast("decimal(27,18)"))


def _cut(batches: Iterator[pa.RecordBatch], length: int, width: np.dtype, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of each document at the ends of windows and of sequences."""
    k = width.itemsize
    for b in batches:
        cols: list[list] = [[] for _ in range(8)]
        row: list[int] = []
        for i, (n, pieces, ids) in enumerate(zip(b.column("n_tokens").to_pylist(), b.column("pieces").to_pylist(), b.column("ids"), strict=True)):
            raw = memoryview(ids.as_buffer())
            for p in sorted(pieces, key=lambda p: p["start"]):
                done, stop, shift = p["start"], p["start"] + p["n"], p["at"] - p["start"]
                while done < stop:
                    seq, off = divmod(shift + done, length)
                    m = min(stop - done, length - off)
                    piece = raw[done * k : (done + m) * k]
                    wide = np.frombuffer(piece, dtype=width).astype("<u4")
                    row.append(i)
                    for c, v in zip(cols, (done, m, zlib.crc32(wide), n, seq, off, p["window"], bytes(piece) if with_ids else None), strict=True):
                        c.append(v)
                    done += m
        pick = pa.array(row, pa.int64())
        longs = [pa.array(c, pa.int64()) for c in cols[:7]]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pick), b.column("source").take(pick), *longs, pa.array(cols[7], pa.binary())],
            names=["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "ids"],
        )
