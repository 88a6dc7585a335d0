"""Column expressions: missing values, canonical text, names, display."""

from __future__ import annotations

import re
import unicodedata
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITE = " \t\r\n"
FLOATS = (T.FloatType, T.DoubleType)
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def quoted(text: str) -> str:
    """As a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# SQL texts about the column or expression c: tables have many columns, and a text is handed to the engine at once.


def trimmed(c: str) -> str:
    return f"trim(BOTH ' \\t\\r\\n' FROM {c})"


def missing(c: str, kind: T.DataType) -> str:
    """Null or NaN; lists also if empty or all of their elements are missing."""
    if isinstance(kind, FLOATS):
        return f"({c} IS NULL OR isnan({c}))"
    if isinstance(kind, T.ArrayType):
        inner = "e IS NULL OR isnan(e)" if isinstance(kind.elementType, FLOATS) else "e IS NULL"
        return f"({c} IS NULL OR size({c}) = 0 OR forall({c}, e -> {inner}))"
    return f"({c} IS NULL)"


def blank(c: str, kind: T.DataType) -> str:
    return f"({c} IS NOT NULL AND {trimmed(c)} = '')" if isinstance(kind, T.StringType) else "FALSE"


def digits15(x: str) -> str:
    """The double nearest to x at 15 significant digits, and one zero: numbers that read alike are equal afterwards. Arithmetic where powers of ten are exact, text beyond."""
    tens = f"array({', '.join(f'1e{k}D' for k in range(23))})"
    scale = f"element_at({tens}, cast(greatest(1, least(23, 15 - floor(log10(abs({x}))))) AS int))"
    return f"CASE WHEN {x} = 0 THEN 0D WHEN abs({x}) >= 1e-6D AND abs({x}) < 1e14D THEN rint({x} * {scale}) / {scale} WHEN {x} IS NOT NULL THEN cast(format_string('%.14e', {x}) AS double) END"


def number_sql(x: str) -> str:
    """Plain decimal notation at 15 significant digits (up to 1e20 and 18 decimals)."""
    exact = f"cast(try_cast(try_cast(format_string('%.14e', {x}) AS double) AS decimal(38, 18)) AS string)"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} % 1D = 0 AND abs({x}) < 1e15D THEN cast(try_cast({x} AS bigint) AS string) ELSE coalesce(regexp_replace({exact}, r'\\.?0+$', ''), cast({x} AS string)) END"


def number_text(name: str) -> Column:
    return F.expr(number_sql(name))


def canonical(c: str, kind: T.DataType) -> str:
    """The text by which values are told apart: numbers plain at 15 significant digits (1 for 1.0, one zero), UTC seconds, ISO dates, JSON. Doubles must have passed digits15()."""
    if isinstance(kind, FLOATS):
        return f"CASE WHEN {c} = 0 OR (abs({c}) >= 1e-6D AND abs({c}) < 1e15D) THEN {number_sql(c)} ELSE cast({c} AS string) END"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    if isinstance(kind, T.BooleanType):
        return f"upper(cast({c} AS string))"
    if isinstance(kind, (*NESTED, T.VariantType)):
        return f"to_json({c}, map('ignoreNullFields', 'false'))"
    if isinstance(kind, T.BinaryType):
        return f"base64({c})"
    return f"cast({c} AS string)"


def comparable(c: str, kind: T.DataType) -> str:
    """The column, or its JSON where values can't be grouped or hashed as they are (maps and variants, at any depth)."""
    return f"to_json({c}, map('ignoreNullFields', 'false'))" if _holds(kind, (T.MapType, T.VariantType)) else c


def _holds(kind: T.DataType, what: tuple) -> bool:
    inner = [kind.elementType] if isinstance(kind, T.ArrayType) else [f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else []
    return isinstance(kind, what) or any(_holds(k, what) for k in inner)


def code_text(code: object) -> str:
    """The same for a value label's code, a number or its text, as far as the column holds numbers."""
    text = str(code).strip()
    try:
        x = float(text)
    except ValueError:
        return str(code)
    if x != x or abs(x) == float("inf") or not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text):
        return str(code)
    plain = format(Decimal(f"{x + 0.0:.14e}"), "f")
    return plain.rstrip("0").rstrip(".") if "." in plain else plain


def atomic(c: Column, kind: T.DataType) -> Column:
    """A cell as one plain value: ISO dates and times, JSON of nested values with their nulls, all else as it is."""
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if isinstance(kind, (*NESTED, T.VariantType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return F.base64(c) if isinstance(kind, T.BinaryType) else c


def atomicized(df: DataFrame) -> DataFrame:
    """df with every cell as one plain value."""
    return df.select(*[atomic(F.col(f"`{f.name.replace('`', '``')}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def normalized_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def normalize(name: str) -> str:
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def slugify(text: str, fallback: str = "item", joint: str = "_") -> str:
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return re.sub("[^a-z0-9]+", joint, plain).strip(joint) or fallback


def truncated(c: Column, width: int = 120) -> Column:
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width - 1), F.lit("…"))).otherwise(c)


def html_escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def byte_text(c: Column) -> Column:
    """Powers of 1024 with two decimals."""
    x, out = c.cast("double"), F.lit(None).cast("string")
    for i, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        fits = (x >= 1024.0**i) if i == 4 else (x < 1024.0 ** (i + 1))
        out = F.concat(F.format_string("%.2f", x / 1024.0**i), F.lit(f" {unit}")) if i == 4 else F.when(fits, F.concat(F.format_string("%.2f", x / 1024.0**i), F.lit(f" {unit}"))).otherwise(out)
    return F.when(x.isNotNull(), out)


#: Formats by their extensions; those that may be compressed; codec suffixes.
EXTENSIONS = {
    "csv": "csv", "tsv": "tsv", "tab": "tsv", "txt": "txt", "xls": "xls", "xlsx": "xlsx", "dta": "dta", "sas7bdat": "sas7bdat", "xpt": "xpt", "sav": "sav", "zsav": "zsav", "por": "por",
    "rds": "rds", "rda": "rdata", "rdata": "rdata", "json": "json", "jsonl": "jsonl", "ndjson": "jsonl", "parquet": "parquet", "feather": "feather", "arrow": "arrow", "ipc": "ipc", "pkl": "pickle", "pickle": "pickle",
}
COMPRESSIBLE = ("csv", "tsv", "txt", "json", "jsonl", "dta", "sas7bdat", "xpt", "sav", "zsav", "por")
CODEC = r"\.(gz|bz2|xz)$"


def detected_format(path: Column) -> Column:
    """One of twenty formats by extension, or null; a codec suffix is legal for some only."""
    low = F.lower(path)
    packed = low.rlike(CODEC)
    ext = F.regexp_extract(F.regexp_replace(low, CODEC, ""), r"\.([a-z0-9]+)$", 1)
    found = F.element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), ext)
    return F.when(~packed | found.isin(*COMPRESSIBLE), found)


def compression(path: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(path), CODEC, 1), F.lit(""))


def source_stem(path: Column) -> Column:
    base = F.regexp_replace(F.regexp_extract(path, r"[^/]*$", 0), "(?i)" + CODEC, "")
    return F.regexp_replace(base, r"\.[^.]*$", "")


#: Groups of artifacts by their paths. Later rules win.
GROUPS = (("open_science_metadata_report", "public report"), ("categorical_levels|value_labels|documentation_gaps", "dictionary + metadata"), ("data_dictionary|variable_dictionary|dictionary_schema", "dictionary"), ("resolved_config|artifact_manifest", "control"), ("metadata_report", "combined report"))


def artifact_group(path: Column) -> Column:
    """Earlier rules are asked first here, as each is put before those that follow."""
    out = F.lit("metadata")
    for pattern, group in reversed(GROUPS):
        out = F.when(path.rlike(pattern), group).otherwise(out)
    return out


def group_of(path: str) -> str:
    """The same for one path on the driver."""
    return next((group for pattern, group in GROUPS if re.search(pattern, path)), "metadata")
