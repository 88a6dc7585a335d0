"""Shared pieces of the corpus operators: reading tables, cutting lineage, salted lookups, Arrow row streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.shared import fresh_path, remove

#: ASCII white space, as the contracts define words and line ends.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
#: Number of salts; one bit of a long each.
LEAVES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, lost executors cost no recomputation beyond it. Deleted by free(), or when the session's JVM ends."""
    spark = df.sparkSession
    path = fresh_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _TABLES[id(out)] = (out, path)
    return out


#: Tables written by cut() that may still be freed, by their DataFrame.
_TABLES: dict[int, tuple[DataFrame, str]] = {}


def free(*tables: DataFrame) -> None:
    """Deletes tables of cut() that nothing will read any more."""
    for df in tables:
        if found := _TABLES.pop(id(df), None):
            remove(df.sparkSession, found[1])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has, in either case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def keyed_rows(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """docs and the column that tells its rows apart: id_col itself or, where rows share or lack an identifier, a row number added to a written copy."""
    unclear = docs.groupBy(named(id_col).alias("id")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1 or id is null")
    if unclear.isEmpty():
        return docs, id_col
    (row,) = fresh(docs, "_row")
    return cut(docs.withColumn(row, F.monotonically_increasing_id())), row


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. Texts of ASCII alone take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def leaf_of(*keys: Column) -> Column:
    """A salt of 0 to LEAVES - 1 that depends on the row's own identifier alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(LEAVES)).cast("int")


def leaf_mask(leaf: Column) -> Column:
    """To be aggregated: the bits of all salts that a key occurs with."""
    return F.bit_or(F.expr("1L") * F.call_function("shiftleft", F.expr("1L"), leaf))


def with_leaves(df: DataFrame, mask: str, leaf: str) -> DataFrame:
    """A row for each salt that the key occurs with: at most as many as the rows it is joined to, and at most LEAVES for a key."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(LEAVES - 1)), lambda i: F.call_function("getbit", F.col(mask), i) == 1)
    return df.withColumn(leaf, F.explode(bits)).drop(mask)


def pieces_of(batch: pa.RecordBatch, rows: int, size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """A batch in slices of so many rows, and of about so many bytes where rows are long."""
    each = max(1, min(rows, batch.num_rows * size // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, each):
        yield batch.slice(at, each)


def stream(df: DataFrame, columns: list[str], schema: str, rows: Callable[[Iterator[dict]], Iterable[dict]], slice_rows: int = 256) -> DataFrame:
    """mapInArrow over the named columns; rows gets {name: list} of each slice of a batch and yields {name: list} in schema's order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in pieces_of(batch, slice_rows):
                yield {name: part.column(i).to_pylist() for i, name in enumerate(columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in rows(slices(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.select(*[named(c) for c in columns]).mapInArrow(run, target)
