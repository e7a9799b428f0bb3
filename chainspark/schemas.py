"""Row types of the engine. Coordinates, sizes and scores are 64-bit: genomes pass 2^31 bases."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "long": T.LongType(), "longs": T.ArrayType(T.LongType())}


def struct(text: str) -> T.StructType:
    """From `name kind, name kind ...`; needs no session, so workers can import it."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (f.split() for f in text.split(","))])


SIZES = struct("chrom string, size long, ord long")
SEQUENCE = struct("chrom string, chunk_start long, seq string")
PARTITION = struct("kind string, bulk_no long, chrom string, start long, end long")
BLOCKS = "array<struct<size:bigint,dt:bigint,dq:bigint>>"
CHAIN_HEADER = struct("score long, t_name string, t_size long, t_strand string, t_start long, t_end long, q_name string, q_size long, q_strand string, q_start long, q_end long, id string")
PSL = struct(
    "matches long, mismatches long, rep_matches long, n_count long, q_num_insert long, q_base_insert long, t_num_insert long, t_base_insert long, "
    "strand string, q_name string, q_size long, q_start long, q_end long, t_name string, t_size long, t_start long, t_end long, "
    "block_count long, block_sizes longs, q_starts longs, t_starts longs"
)
BED = struct("chrom string, start long, end long, name string")
MANIFEST = struct("reference_name string, reference_genome string, query_name string, query_genome string")
