"""Line dedup: explode normalised lines, hash them, count distinct documents for each hash, drop lines at the threshold, reassemble by position.

A document's distinct line hashes are exploded and counted with map-side combination, so a line of every document
is one row a task. Lines whose hash is frequent come back through a join that is salted by the documents' own
salts. A document then gets the positions that it loses, and its text is put together from the slices between
them, in time linear in its lines.

Defined results: null and empty texts are one empty line. Empty keys (below min_chars code points) never go.
Every row is a document of its own, repeated identifiers included (they lose the same lines, and their output
rows are as many as their input rows). Very long texts are split whole; lines exactly at the threshold (ties) go. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, cut, leaf_mask, leaf_of, named, with_leaves


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends; A-Z must be lower-cased before."""
    return F.trim(line, F.lit(SPACES))


def _hashes(text: Column, min_chars: int) -> Column:
    """Of each line the key's digest, null where the key is too short to be dropped."""
    def digest(line: Column) -> Column:
        return F.when(F.char_length(line_key(line)) >= min_chars, F.unhex(F.md5(line_key(line))))

    return F.transform(F.split(ascii_lower(text), "\n", -1), digest)


def _hashed(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """doc_id, code, leaf, hashes: the digests of a document's lines in order, without its text."""
    text = F.coalesce(named(text_col), F.lit(""))
    code = F.xxhash64(text)
    return docs.select(named(id_col).alias("doc_id"), code.alias("code"), leaf_of(named(id_col), code).alias("leaf"), _hashes(text, min_chars).alias("hashes"))


def _frequent(hashed: DataFrame, min_docs: int) -> DataFrame:
    own = hashed.select("leaf", F.explode(F.array_distinct("hashes")).alias("line_hash")).filter(F.col("line_hash").isNotNull())
    counted = own.groupBy("line_hash").agg(F.count(F.lit(1)).alias("docs"), leaf_mask(F.col("leaf")).alias("leaves"))
    return counted.filter(F.col("docs") >= min_docs)


def frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """line_hash, docs, leaves: the lines of at least min_docs documents, with the salts of the documents that have them."""
    return _frequent(_hashed(docs, id_col, text_col, min_chars), min_docs)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """doc_id, text (what is left), n_lines, n_dropped."""
    text = F.coalesce(named(text_col), F.lit(""))
    code = F.xxhash64(text)
    # Read twice: texts are split and hashed once.
    hashed = cut(_hashed(docs, id_col, text_col, min_chars))
    lines = hashed.select("doc_id", "code", "leaf", F.posexplode("hashes").alias("pos", "line_hash"))
    hot = with_leaves(_frequent(hashed, min_docs).drop("docs"), "leaves", "leaf")
    lost = lines.filter(F.col("line_hash").isNotNull()).join(hot, ["line_hash", "leaf"])
    lost = lost.groupBy(F.xxhash64("doc_id", "code").alias("row_key"), "doc_id", "code").agg(F.array_sort(F.collect_set("pos")).alias("lost"))
    whole = docs.select(named(id_col).alias("doc_id"), code.alias("code"), text.alias("text")).withColumn("row_key", F.xxhash64("doc_id", "code"))
    w, x = whole.alias("w"), lost.alias("x")
    on = (F.col("w.row_key") == F.col("x.row_key")) & F.col("w.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("w.code") == F.col("x.code"))
    rows = w.join(x, on, "left").select("w.doc_id", "w.text", F.coalesce("x.lost", F.array().cast("array<int>")).alias("lost"))
    rows = rows.withColumn("lines", F.split("text", "\n", -1))
    ends = F.concat(F.array(F.lit(-1)), F.col("lost"), F.array(F.size("lines")))
    gaps = F.transform(F.sequence(F.lit(0), F.size("lost")), lambda i: F.slice(F.col("lines"), F.get(F.col("ends"), i) + 2, F.get(F.col("ends"), i + 1) - F.get(F.col("ends"), i) - 1))
    kept = F.when(F.size("lost") == 0, F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    return rows.withColumn("ends", ends).select("doc_id", kept.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.size("lost").cast("long").alias("n_dropped"))


ORACLE = r"""
WITH l AS (
  SELECT r, doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (f.key IS NOT NULL)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r, doc_id
"""
