"""Files to tables: discovery, formats, metadata, readers.

Parquet, delimited text and JSON are read by Spark, distributed, with column pruning and pushed limits. Formats that Spark
can't read (Arrow IPC, workbooks, Stata, SAS) are decoded on the driver, one file at a time, as they are small by nature.
"""

from __future__ import annotations

import datetime as dt
import glob
import hashlib
import io
import json
import lzma
import os
import re
import shutil
import struct
import zipfile
from dataclasses import dataclass, field
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import CODEC, COMPRESSIBLE, EXTENSIONS, byte_text  # noqa: F401
from ..functions.shared import fresh_path, upload
from . import foreign
from .worker import isolated

#: Family, format, extensions, availability.
FORMATS = (
    ("Delimited text", "csv", ".csv", "core"), ("Delimited text", "tsv", ".tsv; .tab", "core"), ("Delimited text", "txt", ".txt", "core"), ("Excel", "xls", ".xls", "unavailable"), ("Excel", "xlsx", ".xlsx", "core"), ("Stata", "dta", ".dta", "core"),
    ("SAS", "sas7bdat", ".sas7bdat", "core"), ("SAS", "sas7bcat", ".sas7bcat (auxiliary)", "auxiliary"), ("SAS", "xpt", ".xpt", "core"), ("SPSS", "sav", ".sav", "core"), ("SPSS", "zsav", ".zsav", "core"), ("SPSS", "por", ".por", "unavailable"),
    ("R", "rds", ".rds", "core"), ("R", "rdata", ".rda; .RData", "core"), ("JSON", "json", ".json", "core"), ("JSON", "jsonl", ".jsonl; .ndjson", "core"), ("Arrow", "parquet", ".parquet", "core"), ("Arrow", "feather", ".feather", "core"),
    ("Arrow", "arrow", ".arrow", "core"), ("Arrow", "ipc", ".ipc", "core"), ("Python", "pickle", ".pkl; .pickle", "disabled unless explicitly enabled"),
)


#: What the formats are called.
DESCRIPTIONS = {
    "csv": "Delimited text (CSV)", "tsv": "Delimited text (TSV/TAB)", "txt": "Delimited text (configured delimiter)", "xls": "Microsoft Excel 97-2003", "xlsx": "Microsoft Excel", "dta": "Stata", "sas7bdat": "SAS data set", "sas7bcat": "SAS catalog (auxiliary)",
    "xpt": "SAS transport", "sav": "SPSS system file", "zsav": "Compressed SPSS system file", "por": "SPSS portable file", "rds": "R serialized object", "rdata": "R workspace", "json": "JSON", "jsonl": "Newline-delimited JSON", "parquet": "Apache Parquet",
    "feather": "Apache Arrow/Feather", "arrow": "Apache Arrow IPC file", "ipc": "Apache Arrow IPC file or stream", "pickle": "Python pickle (explicit opt-in required)",
}
#: Package and function that read a format here, and what is to be known about it.
READER_OF = {
    **dict.fromkeys(("csv", "tsv", "txt"), ("pyspark", "read_delimited")), "xlsx": ("fieldloom", "read_excel"), "dta": ("pandas", "read_stata"), "sas7bdat": ("pandas", "read_sas"), "xpt": ("pandas", "read_sas"), "sav": ("fieldloom", "read_spss"), "zsav": ("fieldloom", "read_spss"),
    "rds": ("fieldloom", "read_r"), "rdata": ("fieldloom", "read_r"), "json": ("pyspark", "read_json"), "jsonl": ("pyspark", "read_json"), "parquet": ("pyspark", "read_parquet"), **dict.fromkeys(("feather", "arrow", "ipc"), ("pyarrow", "read_arrow")), "pickle": ("pandas", "read_pickle"),
}
NOTES = {
    "csv": "May be packed as .gz, .bz2 or .xz.", "tsv": "May be packed as .gz, .bz2 or .xz.", "txt": "The delimiter is configured; may be packed as .gz, .bz2 or .xz.", "xls": "No reader is installed.", "xlsx": "Each chosen sheet is a dataset.", "dta": "Labels, formats and tags of missing values are kept.",
    "sas7bdat": "A catalog beside it is found, but its labels are not read.", "sas7bcat": "Never a dataset of its own.", "xpt": "Versions 5 and 8.", "sav": "Labels, formats and declared missing values are kept.", "zsav": "Labels, formats and declared missing values are kept.", "por": "No reader is installed.",
    "rds": "A table, or a list of tables.", "rdata": "Chosen objects that are tables; others are left out.", "json": "Objects are flattened; an object of record arrays is many tables.", "jsonl": "One record a line.", "parquet": "Read in parts, by column.", "feather": "Version 2.", "arrow": "File, then stream.", "ipc": "File, then stream.",
    "pickle": "Reading one can run code: for trusted files only.",
}


@dataclass
class Dataset:
    df: DataFrame
    name: str
    source_file: str
    source_format: str
    sheet: str | None = None
    object: str | None = None
    label: str | None = None
    notes: str | None = None
    problems: DataFrame | None = None
    file_metadata: dict = field(default_factory=dict)
    dataset_id: str = ""


def detect_format(path: str) -> str | None:
    low = os.path.basename(path).lower()
    packed = re.search(CODEC, low)
    found = EXTENSIONS.get(re.sub(CODEC, "", low).rpartition(".")[2])
    return found if not packed or found in COMPRESSIBLE else None


def is_auxiliary(path: str) -> bool:
    return bool(re.search(r"\.sas7bcat(\.(gz|bz2|xz))?$", path, re.IGNORECASE))


def stem(path: str) -> str:
    return os.path.splitext(re.sub(CODEC, "", os.path.basename(path), flags=re.IGNORECASE))[0]


def discover(inputs: list[str], recursive: bool = False, include_hidden: bool = False) -> list[str]:
    """Absolute paths, without repeats, in order; folders are listed, globs and ~ expanded."""
    found = set()
    for given in inputs:
        for path in glob.glob(os.path.expanduser(given)):
            if os.path.isdir(path) and detect_format(path) != "parquet":
                entries = (os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs) if recursive else (os.path.join(path, f) for f in os.listdir(path))
                found |= {os.path.abspath(p) for p in entries if os.path.isfile(p) and (include_hidden or not os.path.basename(p).startswith("."))}
            else:
                found.add(os.path.abspath(path))
    return sorted(found)


def md5_of(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "md5").hexdigest()


def file_metadata(path: str, md5: bool = False) -> dict:
    s = os.stat(path)
    utc = lambda x: None if x is None else dt.datetime.fromtimestamp(x, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    packed, kind = re.search(CODEC, path.lower()), detect_format(path) or ("sas7bcat" if is_auxiliary(path) else None)
    return {
        "source_file": path, "source_basename": os.path.basename(path), "source_extension": os.path.splitext(re.sub(CODEC, "", path, flags=re.IGNORECASE))[1] + (packed[0] if packed else ""), "source_format": kind, "source_format_description": DESCRIPTIONS.get(kind), "compression": packed[1] if packed else None, "file_size_bytes": float(s.st_size), "file_size_human": human(float(s.st_size)),
        "file_created_utc": utc(getattr(s, "st_birthtime", None)), "file_modified_utc": utc(s.st_mtime), "file_accessed_utc": utc(s.st_atime), "file_status_changed_utc": utc(s.st_ctime), "file_owner": _named("pwd", "getpwuid", "pw_name", s.st_uid), "file_group": _named("grp", "getgrgid", "gr_name", s.st_gid), "file_permissions": oct(s.st_mode & 0o777)[2:], "file_md5": md5_of(path) if md5 and os.path.isfile(path) else None,
    }


def human(size: float) -> str:
    """Powers of 1024 with two decimals."""
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if size < 1024 or unit == "TB":
            return f"{size:.2f} {unit}"
        size /= 1024
    return ""


def _named(module: str, function: str, attribute: str, number: int) -> str:
    """Name of an owner or group, or its number where the system has no name for it."""
    import importlib

    try:
        return getattr(getattr(importlib.import_module(module), function)(number), attribute)
    except (ImportError, KeyError):
        return str(number)


def flattened(df: DataFrame) -> DataFrame:
    """Structs' fields become a.b columns; arrays stay."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        out = []
        for f in df.schema.fields:
            c = F.col(f"`{f.name}`")
            out += [c[g.name].alias(f"{f.name}.{g.name}") for g in f.dataType.fields] if isinstance(f.dataType, T.StructType) else [c]
        df = df.select(*out)
    return df


def _unpacked(spark: SparkSession, path: str) -> str:
    """Hadoop has no xz codec: such files are unpacked into the shared folder, where executors see them."""
    if not path.lower().endswith(".xz"):
        return path
    import tempfile

    name = os.path.basename(path)[:-3]
    with tempfile.TemporaryDirectory() as folder:
        local = os.path.join(folder, name)
        with lzma.open(path) as f, open(local, "wb") as g:
            shutil.copyfileobj(f, g, 1 << 20)
        out = fresh_path(spark, name)
        upload(spark, local, out)
    return out


#: Names of a delimited file's columns while it is read, and of what a line holds that doesn't fit.
_BAD = "bad"


def _numbered(rows: DataFrame) -> DataFrame:
    """rows of one file with their number in it, from 0: parts of a file are read in its order, and their counts are few."""
    placed = rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    first, starts = 0, []
    # A row for each part of the file.
    for r in placed.groupBy("part").agg(F.sum(F.length("cells") * 0 + 1).alias("n")).orderBy("part").collect():
        starts.append((r.part, first))
        first += r.n
    known = rows.sparkSession.createDataFrame(starts, "part int, first long")
    return placed.join(F.broadcast(known), "part").withColumn("number", F.col("first") + F.col("place"))


def read_delimited(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """Types are inferred from all lines; cells "" and NA are null. Names are those of the header as they stand, blank and repeated ones too.

    A record whose number of fields isn't the header's is filled with nulls or cut, and becomes a problem: its number
    (the header's is 1), the number of its fields, what was expected, and the record itself. Files are read in parts,
    unless a record goes on over a line's end: then (an odd number of quotes in some line) the file is one part.
    A file without a byte is a table without columns.
    """
    sep = {"csv": ",", "tsv": "\t"}.get(kind, config["input"]["text_delimiter"])
    where = _unpacked(spark, path)
    over = not spark.read.text(where).filter(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).isEmpty()
    # Without column pruning, as otherwise records of a wrong length pass where only some columns are read.
    opts = {"sep": sep, "encoding": config["input"]["text_encoding"], "nullValue": "NA", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "multiLine": over, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": False, "maxCharsPerColumn": -1}
    head = spark.read.options(**opts, header=False).csv(where).head()
    if head is None:
        return [Dataset(spark.createDataFrame([], T.StructType([])), stem(path), path, kind)]
    names = [n or "" for n in head]
    found = spark.read.options(**opts, header=True, inferSchema=True).csv(where).schema
    fields = [T.StructField(f"c{i}", found.fields[i].dataType if i < len(found) else T.StringType()) for i in range(len(names))]
    df = spark.read.options(**opts, header=True, columnNameOfCorruptRecord=_BAD).schema(T.StructType([*fields, T.StructField(_BAD, T.StringType())])).csv(where)
    cells = [F.nullif(F.col(f.name), F.lit("")) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in fields]
    # Reading the corrupt lines alone is refused: the other columns go along, and counts depend on them.
    texts = [F.col(f.name).cast("string") for f in fields]
    raw = df.select(F.coalesce(F.col(_BAD), *texts).alias("actual"), F.concat_ws("", *texts).alias("cells"), (F.col(_BAD).isNotNull() & (F.length(F.concat_ws("", *texts)) >= 0)).alias("wrong"))
    problems = None
    if raw.filter("wrong").agg(F.count("actual")).first()[0]:
        separators = F.regexp_count(F.regexp_replace("actual", '"[^"]*"', ""), F.lit(re.escape(sep)))
        problems = _numbered(raw).filter("wrong").select(F.lit(path).alias("source_file"), (F.col("number") + 2).alias("row"), (separators + 1).cast("long").alias("col"), F.lit(f"{len(names)} columns").alias("expected"), "actual", F.lit(path).alias("problem_file"))
    return [Dataset(df.select(*cells).toDF(*names), stem(path), path, kind, problems=problems)]


def read_json(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """Records become one table; an object whose members are record arrays becomes one table each."""
    where = _unpacked(spark, path)
    if kind == "json":
        df = spark.read.option("multiLine", True).json(where)
        tables = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)]
        if tables and len(tables) == len(df.columns):
            return [Dataset(flattened(df.select(F.inline(F.col(f"`{t}`")))), f"{stem(path)}__{t}", path, kind, object=t) for t in tables]
    else:
        df = spark.read.json(where)
    return [Dataset(flattened(df), stem(path), path, kind)]


def read_parquet(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    return [Dataset(spark.read.parquet(path), stem(path), path, kind)]


def read_arrow(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """File format first, then stream. Dictionary columns keep their values as levels."""
    import pyarrow as pa

    with pa.memory_map(path) as f:
        try:
            table = pa.ipc.open_file(f).read_all()
        except pa.ArrowInvalid:
            f.seek(0)
            table = pa.ipc.open_stream(f).read_all()
    levels = {}
    for i, c in enumerate(table.schema):
        if pa.types.is_dictionary(c.type):
            column = table.column(i).unify_dictionaries() if hasattr(table.column(i), "unify_dictionaries") else table.column(i)
            levels[c.name] = {"levels": [str(v) for v in column.chunk(0).dictionary.to_pylist()] if column.num_chunks else [], "ordered": c.type.ordered}
            table = table.set_column(i, c.name, column.cast(c.type.value_type))
    df = spark.createDataFrame(table)
    return [Dataset(df.select(*[F.col(f"`{c}`").alias(c, metadata=levels[c]) if c in levels else F.col(f"`{c}`") for c in df.columns]), stem(path), path, kind)]


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def workbook(path: str) -> dict[str, list[list]]:
    """Sheets of an .xlsx file in their order: rows of cells (text, number, boolean, time or None)."""
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(path) as z:
        read = lambda n: ElementTree.fromstring(z.read(n))
        shared = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in read("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {r.get("Id"): r.get("Target").lstrip("/") for r in read("xl/_rels/workbook.xml.rels")}
        out, book, times = {}, read("xl/workbook.xml"), _time_styles(read("xl/styles.xml")) if "xl/styles.xml" in z.namelist() else set()
        facts = book.find(f"{_SHEET}workbookPr")
        first = dt.datetime(1904, 1, 1) if facts is not None and facts.get("date1904") in ("1", "true") else dt.datetime(1899, 12, 30)
        for sheet in book.iter(f"{_SHEET}sheet"):
            target, rows = targets[sheet.get(rel)], []
            for r in read(target if target.startswith("xl/") else f"xl/{target}").iter(f"{_SHEET}row"):
                cells: list = []
                for c in r:
                    at = 0
                    for ch in re.match("[A-Z]+", c.get("r", "") or "A")[0]:
                        at = at * 26 + ord(ch) - 64
                    cells += [None] * (at - 1 - len(cells))
                    v, t = c.find(f"{_SHEET}v"), c.get("t", "n")
                    text = "".join(x.text or "" for x in c.iter(f"{_SHEET}t")) if t == "inlineStr" else v.text if v is not None else None
                    cells.append(None if text is None else shared[int(text)] if t == "s" else text == "1" if t == "b" else text if t in ("str", "inlineStr", "e") else first + dt.timedelta(seconds=round(float(text) * 86400)) if int(c.get("s", 0)) in times else float(text) if "." in text or "e" in text.lower() else int(text))
                rows.append(cells)
            out[sheet.get("name")] = rows
    return out


def _time_styles(styles: ElementTree.Element) -> set[int]:
    """Numbers of the cell styles that show dates or times."""
    # Fixed values of the format: its own formats of dates and times.
    shown = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
    for f in styles.iter(f"{_SHEET}numFmt"):
        bare = re.sub(r'"[^"]*"|\\\\.|\[[^\]]*\]', "", f.get("formatCode", ""))
        if re.search("[dmyhs]", bare, re.IGNORECASE) and "General" not in bare:
            shown.add(int(f.get("numFmtId")))
    formats = styles.find(f"{_SHEET}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId", 0)) in shown}


def selected(names: list[str], wanted: str | list[str], what: str) -> list[str]:
    if wanted == "all" or wanted == ["all"]:
        return names
    wanted = [wanted] if isinstance(wanted, str) else list(wanted)
    if unknown := [w for w in wanted if w not in names]:
        raise ValueError(f"unknown {what}: {', '.join(unknown)}")
    return wanted


def _typed(spark: SparkSession, names: list[str], rows: list[list]) -> DataFrame:
    """One type a column: the widest of its cells'."""
    kinds = []
    for i in range(len(names)):
        seen = {type(r[i]) for r in rows if i < len(r) and r[i] is not None}
        kinds.append(T.BooleanType() if seen == {bool} else T.LongType() if seen == {int} else T.DoubleType() if seen and seen <= {int, float} else T.TimestampNTZType() if seen == {dt.datetime} else T.StringType())
    cast = {T.TimestampNTZType: lambda x: x, T.LongType: int, T.DoubleType: float, T.BooleanType: bool, T.StringType: str}
    data = [tuple(None if i >= len(r) or r[i] is None else cast[type(kinds[i])](r[i]) for i in range(len(names))) for r in rows]
    return spark.createDataFrame(data, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


def read_excel(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """Every chosen sheet is a dataset named stem__sheet."""
    sheets, n = workbook(path), config["input"]["n_max"]
    out = []
    for name in selected(list(sheets), config["input"]["excel_sheets"], "sheets"):
        head, *rows = sheets[name] or [[]]
        out.append(Dataset(_typed(spark, [str(h or "") for h in head], rows if n is None else rows[: int(n)]), f"{stem(path)}__{name}", path, kind, sheet=name))
    return out


def _with_labels(spark: SparkSession, frame, labels: dict, values: dict, formats: dict | None = None, more: dict[str, dict] | None = None) -> DataFrame:
    """A pandas table, with what its file says of the columns as their fields' metadata."""
    df = spark.createDataFrame(frame) if len(frame) and len(frame.columns) else spark.createDataFrame([], ", ".join(f"`{c}` string" for c in frame.columns) or T.StructType([]))
    if any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in df.schema.fields):
        df = df.select(*[F.nanvl(F.col(f"`{f.name}`"), F.lit(None)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields])
    meta = lambda c: {k: v for k, v in (("label", labels.get(c)), ("labels", values.get(c)), ("labelled", c in values or None), ("format", (formats or {}).get(c))) if v} | (more or {}).get(c, {})
    return df.select(*[F.col(f"`{c}`").alias(c, metadata=meta(c)) if meta(c) else F.col(f"`{c}`") for c in df.columns])


def _opened(path: str) -> io.BytesIO:
    import bz2
    import gzip

    opener = {".gz": gzip.open, ".bz2": bz2.open, ".xz": lzma.open}.get(os.path.splitext(path)[1].lower(), open)
    with opener(path, "rb") as f:
        return io.BytesIO(f.read())


def read_stata(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """Labels, formats and counts of tagged missing values (.a to .z) are kept as metadata; files of versions 114 and 115 whose tail is damaged, or that have bytes behind it, go to the fixed-width recovery."""
    data, n_max = _opened(path).getvalue(), config["input"]["n_max"]
    reason = trailing_payload(data)
    try:
        if reason:
            raise ValueError(reason)
        found = isolated("dta", data, n_max)
    except Exception as e:
        frame, labels = recovered_stata(data, n_max)
        return [Dataset(_with_labels(spark, frame, labels, {}), stem(path), path, kind, notes=f"read by the fixed-width recovery: {str(e)[:200]}")]
    return [Dataset(_with_labels(spark, found["frame"], found["labels"], found["values"], found["formats"], {c: {"tags": t} for c, t in found["tags"].items() if t}), stem(path), path, kind)]


def trailing_payload(data: bytes) -> str | None:
    """Whether a Stata file of version 114 or 115 has bytes behind its data that begin like an empty table of labels: readers of such files go wrong."""
    if len(data) < 10 or data[0] not in (114, 115):
        return None
    try:
        end = _stata_layout(data)[-1]
    except (struct.error, ValueError, IndexError):
        return "the header can't be read"
    rest = data[end:]
    return "bytes behind an empty table of value labels" if len(rest) > 4 and rest[:4] == b"\0\0\0\0" else None


#: Fixed values of the format: numpy types, and the largest numbers that aren't missing.
_STATA = {251: ("i1", 100), 252: ("i2", 32740), 253: ("i4", 2147483620), 254: ("f4", 1.701e38), 255: ("f8", 8.988e307)}


def _stata_layout(data: bytes):
    """Names, kinds, labels, the row's numpy type, rows, where the data begin and end, by the header of a version 114 or 115 file alone."""
    import numpy as np

    release, order = data[0], "<" if data[1] == 2 else ">"
    if release not in (114, 115):
        raise ValueError(f"no recovery for Stata release {release}")
    nvar, nobs = struct.unpack(order + "hi", data[4:10])
    at = 10 + 81 + 18
    kinds = data[at : at + nvar]
    at += nvar
    text = lambda b: b.split(b"\0")[0].decode("latin-1")
    names = [text(data[at + 33 * i : at + 33 * i + 33]) for i in range(nvar)]
    at += 33 * nvar + 2 * (nvar + 1) + 49 * nvar + 33 * nvar
    labels = {n: text(data[at + 81 * i : at + 81 * i + 81]) for i, n in enumerate(names)}
    at += 81 * nvar
    while True:
        kind, size = struct.unpack(order + "bi", data[at : at + 5])
        at += 5 + size
        if kind == 0:
            break
    dtype = np.dtype([(f"f{i}", f"S{k}" if k <= 244 else order + _STATA[k][0]) for i, k in enumerate(kinds)])
    return names, kinds, labels, dtype, nobs, at, at + nobs * dtype.itemsize


def recovered_stata(data: bytes, n_max: int | None = None):
    """The data block of a version 114 or 115 file."""
    import numpy as np
    import pandas as pd

    names, kinds, labels, dtype, nobs, at, _ = _stata_layout(data)
    text = lambda b: b.split(b"\0")[0].decode("latin-1")
    rows, out = np.frombuffer(data, dtype, nobs if n_max is None else min(nobs, int(n_max)), at), {}
    for i, (n, k) in enumerate(zip(names, kinds, strict=True)):
        x = rows[f"f{i}"]
        out[n] = [text(v) for v in x.tolist()] if k <= 244 else pd.array([None if v > _STATA[k][1] or k >= 254 and not np.isfinite(v) else v for v in x.tolist()], dtype="Int64" if k <= 253 else "Float64")
    frame = pd.DataFrame(out)
    return frame.astype({n: "float64" for n, k in zip(names, kinds, strict=True) if k >= 251 and frame[n].isna().any()}), labels


def read_sas(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    found = isolated(kind, _opened(path).getvalue(), config["input"]["n_max"])
    return [Dataset(_with_labels(spark, found["frame"], {}, {}), stem(path), path, kind)]


def sas_catalog(path: str, config: dict) -> str | None:
    """The configured catalog (absolute or beside the data), else a sibling of the same stem, uncompressed first."""
    folder = os.path.dirname(os.path.abspath(path))
    if given := config["input"]["sas_catalog"]:
        full = given if os.path.isabs(given) else os.path.join(folder, given)
        if not os.path.exists(full):
            raise FileNotFoundError(full)
        return full
    if not config["input"]["auto_sas_catalog"]:
        return None
    found = [f for f in os.listdir(folder) if is_auxiliary(f) and stem(f).lower() == stem(path).lower()]
    return os.path.join(folder, min(found, key=lambda f: (bool(re.search(CODEC, f.lower())), f))) if found else None


def read_pickle(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    if not config["input"]["allow_unsafe_pickle"]:
        raise PermissionError("pickle input is disabled: it can run code; allow_unsafe_pickle enables it for trusted files")
    import pandas as pd

    return [Dataset(df, name, path, kind) for name, df in normalized(spark, pd.read_pickle(path), stem(path)).items()]


def normalized(spark: SparkSession, thing, base: str) -> dict[str, DataFrame]:
    """A table is itself; a map or list of tables is many; a map of equally long lists is one table."""
    import pandas as pd

    if isinstance(thing, DataFrame):
        return {base: thing}
    if isinstance(thing, pd.DataFrame):
        return {base: spark.createDataFrame(thing)}
    if isinstance(thing, dict) and thing and all(isinstance(v, (list, tuple)) for v in thing.values()) and len({len(v) for v in thing.values()}) == 1:
        return {base: spark.createDataFrame(pd.DataFrame({k: list(v) for k, v in thing.items()}))}
    items = list(thing.items()) if isinstance(thing, dict) else list(enumerate(thing)) if isinstance(thing, (list, tuple)) else []
    tables = {str(k) if isinstance(k, str) and k else f"{base}_{i + 1}": v for i, (k, v) in enumerate(items) if isinstance(v, (pd.DataFrame, DataFrame))}
    if not tables:
        raise ValueError("the object holds no table")
    return {k: v if isinstance(v, DataFrame) else spark.createDataFrame(v) for k, v in tables.items()}


def _framed(spark: SparkSession, frame: foreign.Frame, n_max: float | None) -> DataFrame:
    """A decoded table; names are set at the end, as they may be blank or repeated."""
    n = None if n_max is None or n_max == float("inf") else max(0, int(n_max))
    rows = list(zip(*[values[:n] for _, values, *_ in frame.columns], strict=True))
    schema = T.StructType([T.StructField(f"c{i}", T._parse_datatype_string(kind)) for i, (*_, kind) in enumerate(frame.columns)])
    df = spark.createDataFrame(rows, schema)
    return df.select(*[F.col(f"c{i}").alias(name, metadata=meta) if meta else F.col(f"c{i}").alias(name) for i, (name, _, meta, _) in enumerate(frame.columns)])


def read_spss(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """Labels, value labels, formats and declared missing values are kept as metadata."""
    n = config["input"]["n_max"]
    frame = foreign.read_spss(_opened(path).getvalue(), n)
    return [Dataset(_framed(spark, frame, n), stem(path), path, kind, label=frame.label)]


def _r_datasets(spark: SparkSession, path: str, kind: str, config: dict, tables: dict[str, foreign.Frame]) -> list[Dataset]:
    if not tables:
        raise ValueError("the file holds no table")
    many = kind == "rdata" or list(tables) != [stem(path)]
    return [Dataset(_framed(spark, f, config["input"]["n_max"]), f"{stem(path)}__{name}" if many else name, path, kind, object=name if many else None) for name, f in tables.items()]


def read_rds(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """A data frame, or a list of them; levels, labels and formats are kept as metadata."""
    return _r_datasets(spark, path, kind, config, foreign.read_rds(_opened(path).getvalue(), stem(path)))


def read_rdata(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    """The chosen objects of a workspace that are tables or lists of tables; the others are left out."""
    objects, tables = foreign.read_rdata(_opened(path).getvalue(), stem(path)), {}
    for name in selected(list(objects), config["input"]["r_objects"], "R objects"):
        found = foreign.r_tables(objects[name], name)
        tables |= found if list(found) == [name] else {f"{name}__{k}": v for k, v in found.items()}
    return _r_datasets(spark, path, kind, config, tables)


def _unavailable(spark: SparkSession, path: str, kind: str, config: dict) -> list[Dataset]:
    raise NotImplementedError(f"no reader for {kind} files is installed")


READERS = {"csv": read_delimited, "tsv": read_delimited, "txt": read_delimited, "xlsx": read_excel, "xls": _unavailable, "dta": read_stata, "sas7bdat": read_sas, "xpt": read_sas, "sav": read_spss, "zsav": read_spss, "por": _unavailable, "rds": read_rds, "rdata": read_rdata, "json": read_json, "jsonl": read_json, "parquet": read_parquet, "feather": read_arrow, "arrow": read_arrow, "ipc": read_arrow, "pickle": read_pickle}


def read_source(spark: SparkSession, path: str, config: dict) -> list[Dataset]:
    kind = detect_format(path)
    if kind is None:
        raise ValueError(f"unsupported file: {path}")
    out, n = READERS[kind](spark, path, kind, config), config["input"]["n_max"]
    if n is not None and n != float("inf"):
        for d in out:
            d.df = d.df.limit(max(0, int(n)))
    return out


def json_default(x: object) -> str:
    return x.isoformat() if hasattr(x, "isoformat") else str(x)


def to_json(x: object) -> str:
    return json.dumps(x, ensure_ascii=False, default=json_default)
