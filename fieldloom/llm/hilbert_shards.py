"""Sharding along a Hilbert curve: several metadata dimensions are quantised, rows are ordered by their cell's place on the curve, and the order is cut into runs.

Neighbouring cells differ by one step in one dimension, so a run covers a compact box of the dimensions and the
files' minima and maxima (manifest()) let readers skip most of them. Law `rows`: the runs' counts are at most one apart.

There are at most 2 ** (bits x dimensions) cells (4096 by default); the driver reads their counts, nothing else.
Within a cell rows stand by a hash of identifier and text; a cell is dealt by ranges of that hash into as many buckets
as its rows need, so a cell with a third of all rows is spread out, and a row's rank is its cell's start, its
bucket's start and its number in the bucket.

Defined results: null text has size 1 and the CRC of no bytes. Null metadata is cell 0 of its dimension. Rows that
repeat an identifier get slots of their own, as do null identifiers, which the text tells apart; rows of equal hashes
(ties) stand by identifier, CRC and size. Very long texts count whole, in bytes. An empty table gives an empty result.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, named

#: Rows of a bucket, and buckets of all cells, about.
BUCKET_ROWS, BUCKETS = 1_000, 32_768


def hilbert_index(point: Sequence[int], bits: int) -> int:
    """The place on the curve through the 2 ** bits cells of each dimension: Gray-code rotations from the highest bit down."""
    x, top = list(point), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(len(x)):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip, q = 0, top
    while q > 1:
        if x[-1] & q:
            flip ^= q - 1
        q >>= 1
    index = 0
    for bit in reversed(range(bits)):
        for value in x:
            index = index << 1 | ((value ^ flip) >> bit & 1)
    return index


def category(value: Column, bits: int) -> Column:
    """A cell for a text of few values: 0 for null, else by its CRC."""
    return F.when(value.isNull(), 0).otherwise(F.crc32(value) % ((1 << bits) - 1) + 1).cast("int")


def magnitude(value: Column, bits: int, least: int = 3) -> Column:
    """A cell by the power of two, all up to 2 ** least in the first."""
    return F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), F.floor(F.log2(value)) - least)).cast("int")


def hilbert_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", categories: Sequence[str] = ("source", "lang"), shards: int = 16, bits: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, cell (the curve's index), and the quantised dimensions q0, q1 ...: a row for each row of docs."""
    text = F.coalesce(named(text_col), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    dims = [category(named(c).cast("string"), bits) for c in categories] + [magnitude(size, bits)]
    names = [f"q{i}" for i in range(len(dims))]
    packed = sum((F.col(q) * (1 << bits * i) for i, q in enumerate(names)), F.lit(0)).cast("int")
    rows = docs.select(named(id_col).alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(named(id_col), text).alias("code"), *[d.alias(q) for d, q in zip(dims, names, strict=True)])
    rows = cut(rows.withColumn("packed", packed))
    counts = {r.packed: r["count"] for r in rows.groupBy("packed").count().collect()}
    total, most, start, cells = sum(counts.values()), max(BUCKET_ROWS, -(-sum(counts.values()) // BUCKETS)), 0, []
    for cell, code in sorted((hilbert_index([p >> bits * i & (1 << bits) - 1 for i in range(len(dims))], bits), p) for p in counts):
        cells.append((code, cell, -(-counts[code] // most), start))
        start += counts[code]
    spark = docs.sparkSession
    placed = spark.createDataFrame(cells, "packed int, cell int, buckets int, cell_start long")
    rows = rows.join(F.broadcast(placed), "packed").withColumn("bucket", F.floor(F.pmod("code", F.lit(65536)) * F.col("buckets") / 65536).cast("int"))
    starts = rows.groupBy("cell", "bucket").count()
    starts = starts.select("cell", "bucket", F.coalesce(F.sum("count").over(Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("bucket_start"))
    number = F.row_number().over(Window.partitionBy("cell", "bucket").orderBy("code", "doc_id", "text_crc32", "size")) - 1
    rows = rows.withColumn("number", number).join(starts, ["cell", "bucket"]).withColumn("rank", F.col("cell_start") + F.col("bucket_start") + F.col("number"))
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return rows.withColumn("shard", shard.cast("int")).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "cell", *names)


def manifest(sharded: DataFrame) -> DataFrame:
    """Rows, bytes and the range of each dimension, for each shard: what a reader prunes by."""
    dims = [c for c in sharded.columns if c == "cell" or c[0] == "q" and c[1:].isdigit()]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *[f(c).alias(f"{c}_{n}") for c in dims for n, f in (("min", F.min), ("max", F.max))])
