"""Whole runs: from two genomes to cleaned chains, or from a later stage's input.

Every stage is a table below the output folder, written once and counted; a run that begins later
reads the table of the stage before. What a stage keeps on its way is deleted behind it. Stages: `partitions`, `bundles`, `chains`, `antirepeat`, `filled`,
`suspects`, `final`.

The partitions are the run's account of both genomes (chunks and bulks, and how many pairs they make).
Words, extensions, gap fills and scores fetch the bases they need by place, so no chromosome is ever a
row, and alignments aren't cut where a chunk ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequences import DEFAULT, read_scoring, reverse_complement
from ..operators import align, antirepeat, bundle, chaining, chains, cleaning, fill, netlevels, nets, partition, psl, seeds
from ..operators.tiles import lengths
from ..params import Params
from ..scratch import Scratch, scope


class Run:
    """One pair of genomes, each (chrom, seq) or, as the sources give them, (chrom, chunk_start, seq)."""

    def __init__(self, spark: SparkSession, target: DataFrame, query: DataFrame, params: Params, out: str):
        text = lambda g: g.withColumn("chrom", F.col("chrom").cast("string"))
        self.spark, self.target, self.query, self.p, self.out = spark, text(target), text(query), params.validate(), out.rstrip("/")
        self.scoring = read_scoring(spark, params.score_scheme) if params.score_scheme else DEFAULT
        self.counts: dict[str, int] = {}

    def kept(self, df: DataFrame, stage: str, by: str | None = None) -> DataFrame:
        """`df` as the table of a stage; an error unless it holds as many rows as were written."""
        seen, path = Observation(), f"{self.out}/{stage}"
        w = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        (w.partitionBy(by) if by else w).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.counts[stage] = int(seen.get["n"])
        if back.count() != self.counts[stage]:
            raise RuntimeError(f"stage {stage} lost rows")
        return back

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{stage}")

    # --- stages ---

    def partitions(self) -> DataFrame:
        """(side, kind, no, part) of both genomes."""
        sides = []
        for side, genome, chunk, overlap in (("reference", self.target, self.p.reference_chunk, self.p.reference_overlap), ("query", self.query, self.p.query_chunk, self.p.query_overlap)):
            sizes = lengths(genome).withColumn("ord", F.lit(0).cast("long"))
            sides.append(partition.partitions(sizes, chunk, overlap, f"{side}.2bit").select(F.lit(side).alias("side"), "*"))
        return sides[0].union(sides[1])

    def check_partitions(self) -> None:
        """An error unless the written partitions hold every base of both genomes, each chunk and bulk once."""
        parts = self.read("partitions")
        again = parts.groupBy("side", "part").count().where("count > 1").first()
        if again:
            raise RuntimeError(f"partition {again['part']} of the {again['side']} is listed twice")
        for side, genome in (("reference", self.target), ("query", self.query)):
            # a name with a colon can't be read back from a bulk
            gone = partition.uncovered(parts.where(F.col("side") == side), lengths(genome)).where(~F.contains("chrom", F.lit(":"))).first()
            if gone:
                raise RuntimeError(f"{gone['uncovered']} bases of {gone['chrom']} ({side}) are in no partition")

    def expected_pairs(self) -> int:
        """How many pairs of partitions a run covers."""
        parts = self.read("partitions")
        return int(partition.expected_pairs(parts.where("side = 'reference'"), parts.where("side = 'query'")).first()["expected"])

    def strands(self) -> list[tuple[str, DataFrame]]:
        """The query as it is, and its reverse complement with places counted on it."""
        q = self.query if "chunk_start" in self.query.columns else self.query.withColumn("chunk_start", F.lit(0).cast("long"))
        turned = q.join(lengths(q), "chrom").select("chrom", (F.col("size") - F.col("chunk_start") - F.length("seq")).alias("chunk_start"), reverse_complement(F.col("seq")).alias("seq"))
        return [("+", q.select("chrom", "chunk_start", "seq")), ("-", turned)]

    def aligned(self) -> DataFrame:
        """PSL rows of gapped alignments on both strands of the query."""
        parts, k = [], self.p.seed_length
        words = seeds.coded_kmers(seeds.overlapping(self.target, k), k)
        for strand, q in self.strands():
            hits = seeds.seed_hits(words, seeds.coded_kmers(seeds.overlapping(q, k), k), self.p.seed_limit)
            found = align.gapped(seeds.hsps(hits, k, self.target, q, self.p.lastz_k, scoring=self.scoring), self.target, q, self.p.lastz_l, self.p.lastz_y, scoring=self.scoring)
            found = Scratch(self.spark, "aligned").keep(found, f"strand{len(parts)}")
            found = found.unionByName(fill.interpolated(found, self.target, q, self.p.inner_threshold(), self.p.lastz_y, scoring=self.scoring))
            parts.append(psl.from_blocks(found.withColumn("strand", F.lit(strand))))
        return chains.merged(*parts)

    def bundles(self, rows: DataFrame) -> DataFrame:
        """Alignments with the bundle of their reference chromosome, largest chromosomes first."""
        sizes = lengths(self.target).withColumn("ord", F.lit(0).cast("long"))
        return bundle.bundled_rows(rows, bundle.bundles(sizes, rows.select(F.col("t_name").alias("chrom")), self.p.bundle_max_bases))

    @staticmethod
    def blocks(rows: DataFrame) -> DataFrame:
        """(t_name, q_name, q_strand, t, q, size, aid): distinct blocks of PSL rows."""
        b = rows.select("t_name", "q_name", F.col("strand").alias("q_strand"), F.explode(F.arrays_zip("t_starts", "q_starts", "block_sizes")).alias("b"))
        b = b.select("t_name", "q_name", "q_strand", F.col("b.t_starts").alias("t"), F.col("b.q_starts").alias("q"), F.col("b.block_sizes").alias("size")).distinct()
        return b.withColumn("aid", F.xxhash64("t_name", "q_name", "q_strand", "t", "q", "size"))

    def chain(self, blocks: DataFrame) -> DataFrame:
        """Chains of at least the least score, and their blocks: one table, by chain id."""
        best = chaining.chained(blocks, self.p.min_chain_score, self.p.linear_gap, self.p.max_chain_gap)
        named = best.withColumn("cid", F.xxhash64("t_name", "q_name", "q_strand", "island", "chain"))
        member = named.select("cid", "score", F.explode("members").alias("aid"))
        return blocks.join(member, "aid").select("cid", "score", "t_name", "q_name", "q_strand", "t", "q", "size")

    def without_repeats(self, rows: DataFrame) -> DataFrame:
        heads = rows.select("cid", "score", "t_name").distinct().withColumn("t_start", F.lit(0).cast("long"))
        good = antirepeat.adjusted(antirepeat.composition(heads, rows.select("cid", F.col("t").alias("t_off"), "size"), self.target), self.p.antirepeat_min_score).where("kept")
        return rows.join(good.select("cid"), "cid", "left_semi")

    def filled(self, rows: DataFrame) -> DataFrame:
        """The chains with alignments found inside their gaps, on the chain's strand."""
        w = Window.partitionBy("cid").orderBy("t", "q")
        g = rows.select("cid", "t_name", "q_name", "q_strand", F.row_number().over(w).cast("long").alias("i"), (F.col("t") + F.col("size")).alias("t_from"), F.lead("t").over(w).alias("t_to"), (F.col("q") + F.col("size")).alias("q_from"), F.lead("q").over(w).alias("q_to")).where("t_to is not null")
        some = chains.fillable(g, self.p.fill_gap_min, self.p.fill_gap_max).join(lengths(self.query).select(F.col("chrom").alias("q_name"), F.col("size").alias("q_size")), "q_name")
        inside = fill.gap_sequences(some, self.target, self.query, not self.p.skip_unmask).repartition(self.p.fill_files, "cid", "i")
        found = fill.fillings(inside, self.p.fill_score, self.p.fill_k, self.p.lastz_y, table=self.p.linear_gap, scoring=self.scoring)
        heads = rows.select("cid", "score", "t_name", "q_name", "q_strand").distinct()
        return fill.spliced(rows, found).join(heads, "cid").select("cid", "score", "t_name", "q_name", "q_strand", "t", "q", "size")

    def rescored(self, rows: DataFrame) -> DataFrame:
        """One row a chain: header, score of its bases less its gaps, block list; numbered by score."""
        return self.numbered(self.headed(rows))

    def numbered(self, table: DataFrame) -> DataFrame:
        """`table` with ids from 1, best score first; it is written first, since numbering reads it more than once."""
        table = Scratch(self.spark, "numbered").keep(table, "chains")
        return chains.numbered_by_score(table).withColumn("id", F.col("new_id").cast("string")).drop("new_id")

    def headed(self, rows: DataFrame) -> DataFrame:
        """One row a chain of (cid, t_name, q_name, q_strand, t, q, size): header, score, block list; its id is cid."""
        w = Window.partitionBy("cid").orderBy("t", "q")
        nxt = rows.select("*", (F.lead("t").over(w) - F.col("t") - F.col("size")).alias("dt0"), (F.lead("q").over(w) - F.col("q") - F.col("size")).alias("dq0"), F.row_number().over(w).alias("i"))
        b = nxt.select("cid", "t_name", "q_name", "q_strand", "t", "q", "size", F.col("i").cast("long").alias("i"), F.coalesce("dt0", F.lit(0)).alias("dt"), F.coalesce("dq0", F.lit(0)).alias("dq"))
        heads = b.groupBy("cid", "t_name", "q_name", "q_strand").agg(F.min("t").alias("t_start"), F.max(F.col("t") + F.col("size")).alias("t_end"), F.min("q").alias("q_start"), F.max(F.col("q") + F.col("size")).alias("q_end"))
        size = lambda g, n: lengths(g).select(F.col("chrom").alias(f"{n}_name"), F.col("size").alias(f"{n}_size"))
        heads = heads.join(size(self.target, "t"), "t_name").join(size(self.query, "q"), "q_name")
        score = chains.sequence_scores(b.select("cid", "i", "size", "dt", "dq"), self.target, self.query, heads.select("cid", "t_name", "t_start", "q_name", "q_start", "q_size", "q_strand"), self.p.linear_gap, self.scoring)
        out = heads.join(score, "cid").join(chains.nested(b), "cid")
        return out.withColumn("id", F.col("cid").cast("string")).withColumn("t_strand", F.lit("+")).drop("cid")

    def cleaned(self, table: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(chains without suspects, the suspects as BED): pieces in gaps of better chains are cut out of theirs, and cut chains are rescored."""
        heads = table.select("id", "t_name", "t_start", "q_start", "score")
        b = chains.offsets(chains.unnested(table, "id")).withColumnRenamed("cid", "id").join(heads, "id")
        start, scratch = F.col("t_start") + F.col("t_off"), Scratch(self.spark, "cleaned")
        laid = scratch.keep(b.select("t_name", "id", "score", "i", start.alias("start"), (start + F.col("size")).alias("end"), (F.col("q_start") + F.col("q_off")).alias("q"), "dt", "dq"), "blocks")
        flanks = nets.flanks(chains.unnested(table, "id"), table=self.p.linear_gap).withColumnRenamed("cid", "id").join(heads, "id")
        flanks = flanks.select("id", (F.col("t_start") + F.col("t_from")).alias("t_from"), "left", "right")
        every = cleaning.breaking_pieces(netlevels.net_levels(laid), laid, flanks, heads, self.p.clean_max_suspect, self.p.clean_min_broken, table=self.p.linear_gap)
        every = scratch.keep(every, "breaking")
        found = cleaning.falling_pieces(every, self.p.clean_fold).union(cleaning.falling_pairs(every, self.p.clean_fold_pairs, self.p.clean_pair_distance)).distinct()
        found = scratch.keep(found, "suspects")
        cut = laid.join(found.select("t_name", "id").distinct(), ["t_name", "id"], "left_semi")
        names = table.select("t_name", "id", "q_name", "q_strand")
        rest = cleaning.cut_out(cut, found).join(names, ["t_name", "id"])
        rest = rest.select(F.xxhash64("id", "part").alias("cid"), "t_name", "q_name", "q_strand", F.col("start").alias("t"), "q", (F.col("end") - F.col("start")).alias("size"))
        whole = table.join(found.select("id").distinct(), "id", "left_anti")
        bed = found.select(F.col("t_name").alias("chrom"), "start", "end", F.col("id").alias("name"))
        return self.numbered(whole.unionByName(self.headed(scratch.keep(rest, "rest")).select(whole.columns))), bed

    def run(self) -> DataFrame:
        """The final chains, from the stage that the parameters name."""
        begin = self.p.begin()
        if begin == "full":
            with scope():
                self.kept(self.partitions(), "partitions")
                self.check_partitions()
            with scope():
                self.kept(self.aligned(), "psl")
            with scope():
                self.kept(self.bundles(self.read("psl")), "bundles", "bundle")
            with scope():
                self.kept(self.chain(self.blocks(self.read("bundles"))), "chains")
        if begin in ("full", "antirepeat"):
            with scope():
                self.kept(self.without_repeats(self.read("chains")), "antirepeat")
        if begin != "clean":
            rows = self.read("antirepeat")
            with scope():
                self.kept(self.rescored(rows if self.p.skip_fill else self.filled(rows)), "filled")
        table = self.read("filled")
        if self.p.skip_clean:
            return table
        with scope():
            good, bed = self.cleaned(table)
            self.kept(bed, "suspects")
            return self.kept(chains.at_least(good, self.p.min_chain_score), "final")
