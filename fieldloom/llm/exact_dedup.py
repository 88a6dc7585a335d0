"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations alone.

A row belongs to one of 64 leaves by its identifier. A leaf's run has one entry for each of its digests, in order of
the digest: group size, the identifier that stays, the leaves it came from. In each round the runs of 2 ** FAN_BITS
neighbouring nodes are exchanged and merged into their parent's run, until one is left (64 to 8 to 1): runs are dealt
by (node, key), sorted within their partitions, and merged by sort-based aggregation that streams through equal keys.
The best identifier is kept as a struct, which the engine aggregates over sorted input, on both sides of the exchange.
So a task passes on its part of a run sorted and merged, and a group that holds a third of all rows is 64 entries
after the first round. On the way back a digest is sent only to the leaves that have it, as the merged bits tell.

Verification at each level: a run's key is SHA-256 with the length in bytes and an independent 64-bit hash of the
text, and entries merge only when all three agree. The texts themselves are not compared (they never leave their
partitions): two different texts would have to agree in all of 320 bits and their length.

Defined results: null text counts as empty. Very long texts are digested whole. Null identifiers lose against all
others; a group of null identifiers alone keeps a null. Where rows share or lack an identifier they are told apart by
a row number in a written copy: of rows that repeat identifier and text (a tie), one is kept; all count in
group_size. An empty table gives an empty result. Other columns, whatever their names, pass through keep() untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LEAVES, fresh, keyed_rows, leaf_mask, leaf_of, named, with_leaves

#: Runs merged into one in a round, as a power of two.
FAN_BITS = 3
KEY = ["digest", "bytes", "check"]


def _digested(docs: DataFrame, id_col: str, row_col: str, text_col: str) -> DataFrame:
    """id, row (what tells rows apart), leaf and the key; no part of the key can be null, or the join would digest texts once more to ask."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    return docs.select(named(id_col).alias("id"), named(row_col).alias("row"), leaf_of(named(row_col)).alias("leaf"), F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest"), F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("check"))


def _merged(run: DataFrame, node: Column, best: Column, size: Column, leaves: Column) -> DataFrame:
    """The runs of one level, merged into those of the nodes above."""
    runs = run.withColumn("leaf", node)
    return runs.groupBy("leaf", *KEY).agg(size.alias("size"), best.alias("best"), leaves.alias("leaves"))


def _verdicts(rows: DataFrame, keep: str) -> DataFrame:
    """The last run, with a row for each leaf that has the digest: KEY, leaf, size, best (known, id, row)."""
    # Null identifiers lose: "known" is ordered before the identifier; of equal identifiers one row wins.
    best = {"largest": F.max, "smallest": F.min}[keep]
    known = F.col("id").isNotNull() if keep == "largest" else F.col("id").isNull()
    run = rows.withColumn("best", F.struct(known.alias("known"), F.col("id"), F.col("row")))
    run = _merged(run, F.col("leaf"), best("best"), F.count(F.lit(1)), leaf_mask(F.col("leaf")))
    top = (LEAVES - 1).bit_length()
    for level in range(0, top, FAN_BITS):
        node = F.lit(0) if level + FAN_BITS >= top else F.shiftright("leaf", FAN_BITS)
        run = _merged(run, node, best("best"), F.sum("size"), F.bit_or("leaves"))
    return with_leaves(run.drop("leaf"), "leaves", "leaf")


def _judged(docs: DataFrame, id_col: str, row_col: str, text_col: str, keep: str) -> DataFrame:
    """id, row, digest, size, best, kept: a row for each row of docs, without its text."""
    rows = _digested(docs, id_col, row_col, text_col)
    judged = rows.join(_verdicts(rows, keep), [*KEY, "leaf"])
    return judged.select("id", "row", "digest", "size", "best", F.col("row").eqNullSafe(F.col("best.row")).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each row of docs, dropped ones too."""
    keyed, row = keyed_rows(docs, id_col)
    judged = _judged(keyed, id_col, row, text_col, keep)
    return judged.select(F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", which: str = "largest") -> DataFrame:
    """The rows of docs that stay, with all their columns: rows are judged without their texts, then those that go are taken out."""
    keyed, row = keyed_rows(docs, id_col)
    (gone,) = fresh(keyed, "_gone")
    lost = _judged(keyed, id_col, row, text_col, which).filter("not kept").select(F.col("row").alias(gone))
    return keyed.join(lost, named(row) == F.col(gone), "left_anti").select(*[named(c) for c in docs.columns])


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
