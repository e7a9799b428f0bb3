"""Merkle manifest of a data set: a leaf for each row, a binary tree for each language, one over languages.

Rows are hashed by Spark where they are read, so that only digests travel. They are range-sorted by
(lang, doc_id), numbered within their language, and cut into aligned buckets of 2^10 leaves. A task hands the
Arrow table of its buckets to DuckDB, which builds one level after another (`sha256(string_agg(h, '' ORDER
BY node))` by pairs) and folds every leaf, the tampered one where there is one, upward along its siblings.
What leaves the task are the buckets' roots and each leaf's inner proof and folded bucket root. Above
buckets Spark combines roots ten levels at a time in array functions, gives each bucket its outer path, and
joins paths back to leaves; the tree over languages is built the same way.

Edge cases: a null field is hashed as `-`, an empty text as `0:`; null doc_id sorts first and is never
tampered with; rows of one doc_id sort by leaf, and equal rows are leaves of their own; null lang is a
language, before all others; n_chars that is null stays so when tampered with; an empty table gives an
empty result; further columns are ignored. Texts are hashed whole.
"""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, schema_of
from .ordered import positions, range_sorted, range_starts, with_starts

#: Levels of the tree inside a bucket; a bucket holds 2^LEVELS leaves.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<l:string,r:string>>"
GROWN = "doc_id long, tree long, bucket long, node long, leaf string, proof string, fold string, bucket_root string"


def field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(**instead: Column) -> Column:
    return F.sha2(F.concat(*[field(instead.get(c, F.col(c))) for c in FIELDS]), 256)


def depth(leaves: Column) -> Column:
    """Levels above that many leaves."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(F.lit(0)).cast("int")


# --- inside buckets --------------------------------------------------------------------------------

_CONNECTION: list[duckdb.DuckDBPyConnection] = []


def connection() -> duckdb.DuckDBPyConnection:
    """The worker's own database, in memory."""
    if not _CONNECTION:
        _CONNECTION.append(duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""}))
    return _CONNECTION[0]


def folded_buckets(rows: pa.Table, levels: int) -> pa.Table:
    """Level by level: nodes of the next level, and each leaf's proof and fold, as far as its bucket goes (`deep`)."""
    c = connection()
    c.register("arrived", rows)
    c.execute("CREATE OR REPLACE TEMP TABLE nodes AS SELECT tree, bucket, node, deep, leaf AS h FROM arrived")
    c.execute("CREATE OR REPLACE TEMP TABLE walk AS SELECT *, node AS spot, '' AS proof, coalesce(tampered, leaf) AS fold FROM arrived")
    for k in range(levels):
        c.execute(
            f"""CREATE OR REPLACE TEMP TABLE walk AS
            SELECT w.* REPLACE (w.spot >> 1 AS spot, w.proof || coalesce(s.h, '') AS proof,
              CASE WHEN w.deep <= {k} THEN w.fold WHEN w.spot & 1 = 1 THEN sha256(s.h || w.fold) ELSE sha256(w.fold || coalesce(s.h, '')) END AS fold)
            FROM walk AS w LEFT JOIN nodes AS s ON s.tree = w.tree AND s.bucket = w.bucket AND s.node = xor(w.spot, 1)"""
        )
        c.execute(
            f"""CREATE OR REPLACE TEMP TABLE nodes AS
            SELECT tree, bucket, node >> 1 AS node, deep, CASE WHEN deep <= {k} THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY node)) END AS h
            FROM nodes GROUP BY tree, bucket, node >> 1, deep"""
        )
    out = c.sql("SELECT w.doc_id, w.tree, w.bucket, w.node, w.leaf, w.proof, w.fold, n.h AS bucket_root FROM walk AS w JOIN nodes AS n USING (tree, bucket)").to_arrow_table()
    c.unregister("arrived")
    return out


# --- above buckets ---------------------------------------------------------------------------------


def combined(nodes: DataFrame, most: int, levels: int = LEVELS) -> DataFrame:
    """(tree, node, path, root) of (tree, node, h, deep): the siblings on the way up, and the tree's root.

    `levels` levels at a time: at most 2^levels nodes meet in a row, and only their common root goes on.
    `most` is the largest `deep`.
    """
    if most <= 0:
        return nodes.select("tree", "node", F.array().cast(STEP).alias("path"), F.col("h").alias("root"))
    fan = 1 << levels
    met = nodes.groupBy("tree", F.floor(F.col("node") / fan).cast("long").alias("up")).agg(F.max("deep").alias("deep"), F.transform(F.sort_array(F.collect_list(F.struct("node", "h"))), lambda x: x["h"]).alias("hs"))
    pair = lambda a, i: F.sha2(F.concat(F.get(a, 2 * i), F.coalesce(F.get(a, 2 * i + 1), F.lit(""))), 256)
    halved = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / 2).cast("int")), lambda i: pair(a, i))
    tiers = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array("hs"), lambda acc, k: F.when(k <= F.col("deep"), F.concat(acc, F.array(halved(F.element_at(acc, -1))))).otherwise(acc))
    met = met.withColumn("tiers", tiers)
    # a whole number of pairs lies below each place: place i of tier k is i div 2^k
    up = lambda i, k: F.floor(i / F.pow(F.lit(2.0), k)).cast("int")
    side = lambda i, k: F.struct(
        F.when(up(i, k) % 2 == 1, F.get(F.get("tiers", k), up(i, k) - 1)).otherwise(F.lit("")).alias("l"),
        F.when(up(i, k) % 2 == 0, F.coalesce(F.get(F.get("tiers", k), up(i, k) + 1), F.lit(""))).otherwise(F.lit("")).alias("r"),
    )
    ways = F.transform("hs", lambda _, i: F.transform(F.slice(F.sequence(F.lit(0), F.size("tiers")), 1, F.size("tiers") - 1), lambda k: side(i, k)))
    low = met.select("tree", "up", F.posexplode(ways).alias("i", "way")).select("tree", "up", (F.col("up") * fan + F.col("i")).alias("node"), "way")
    top = combined(met.select("tree", F.col("up").alias("node"), F.get(F.element_at("tiers", -1), F.lit(0)).alias("h"), F.greatest(F.col("deep") - levels, F.lit(0)).alias("deep")), most - levels, levels)
    return low.join(top.withColumnRenamed("node", "up"), ["tree", "up"]).select("tree", "node", F.concat("way", "path").alias("path"), "root")


# --- the manifest ----------------------------------------------------------------------------------


def manifest(documents: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """(doc_id, lang_no, position, leaf, subroot, root, proof_sha256, folded_root, verified), one row a document.

    `tampered`: the leaf that a document shows later, null where it is unchanged; `folded_root` is what it
    leads to along the siblings of the manifest, and `verified` tells whether that is the root.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "merkle")
    shown = F.lit(None).cast("string") if tampered is None else tampered
    hashed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", leaf().alias("leaf"), shown.alias("tampered"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("row")]
    dealt = range_sorted(scratch.keep(hashed, "leaves"), order, scratch, "sorted")
    starts = range_starts(dealt, ["lang"])
    langs = positions(starts.groupBy("lang").agg(F.sum("_rows").alias("n")), [F.col("lang").asc_nulls_first()], scratch, "by-name")
    langs = scratch.keep(langs.select("lang", F.col("idx").alias("tree"), "n", depth(F.col("n")).alias("lang_deep")), "langs")
    n_langs, total, most = langs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("lang_deep"), F.lit(0))).first()
    named = langs.select(F.col("lang").alias("_lang"), "tree", "lang_deep")
    starts = starts.join(named, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang", "_rows")
    at = F.col("_at") + F.col("_shift")
    rows = with_starts(dealt, starts, ["lang"]).select("doc_id", "tree", F.shiftright(at, levels).alias("bucket"), at.bitwiseAND(F.lit((1 << levels) - 1)).alias("node"), F.least("lang_deep", F.lit(levels)).alias("deep"), "leaf", "tampered")
    # about as many groups as there are full buckets; the small buckets of small languages share groups
    part = F.pmod(F.xxhash64("tree", "bucket"), F.lit((total >> levels) + 1))
    grown = rows.withColumn("part", part).groupBy("part").applyInArrow(lambda t: folded_buckets(t, levels), schema_of(GROWN))
    inner = scratch.keep(grown, "inner")
    # one row a bucket, and its way up to the root over all languages
    tops = inner.where("node = 0").join(langs, "tree").select("tree", F.col("bucket").alias("node"), F.col("bucket_root").alias("h"), F.greatest(F.col("lang_deep") - levels, F.lit(0)).alias("deep"))
    outer = scratch.keep(combined(tops, most - levels, levels), "outer")
    deep = (n_langs - 1).bit_length() if n_langs else 0
    over = combined(outer.where("node = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("node"), F.col("root").alias("h"), F.lit(deep).alias("deep")), deep, levels)
    over = over.select(F.col("node").alias("tree"), F.col("path").alias("on"), F.col("root").alias("all"))
    paths = outer.join(over, "tree").select("tree", F.col("node").alias("bucket"), F.concat("path", "on").alias("path"), F.col("root").alias("subroot"), F.col("all").alias("root"))
    flat = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    out = inner.join(paths, ["tree", "bucket"]).select(
        "doc_id",
        F.col("tree").alias("lang_no"),
        (F.shiftleft("bucket", levels) + F.col("node")).alias("position"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat("proof", flat), 256).alias("proof_sha256"),
        F.aggregate("path", F.col("fold"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256)).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
