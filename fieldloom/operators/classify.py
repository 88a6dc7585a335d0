"""Role hints, semantic types and cardinality classes: cascades over the table of columns' statistics."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import FLOATS, INTEGERS, NESTED, code_text, normalize
from .profile import DURATIONS, Table, frequencies, pattern_ratios, stats


def kind_of(f: T.StructField, config: dict) -> str:
    """The rule that a column's type and metadata call for; the cascade below gives each its result."""
    p, m, t = config["profiling"], f.metadata or {}, f.dataType
    if isinstance(t, T.DateType):
        return "date"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(t, DURATIONS):
        return "duration"
    if m.get("levels") is not None:
        return "ordered" if m.get("ordered") else "factor" if p["factor_always_categorical"] else "other_integer"
    if m.get("labelled") and m.get("labels") and p["labelled_always_categorical"]:
        return "labelled"
    if isinstance(t, T.BooleanType):
        return "logical" if p["logical_as_categorical"] else "other_logical"
    if isinstance(t, T.StringType):
        return "text"
    if isinstance(t, INTEGERS):
        return "integer"
    if isinstance(t, (*FLOATS, T.DecimalType)):
        return "double"
    if m.get("complex"):
        return "complex"
    if isinstance(t, (*NESTED, T.VariantType)):
        return "nested"
    return "raw" if isinstance(t, T.BinaryType) else f"other_{t.typeName()}"


def name_hints(names: list[str], config: dict) -> list[tuple[bool, bool]]:
    """(identifier-like, sensitive) for each name."""
    p = config["privacy"]
    hit = lambda patterns, n: any(re.search(x, n, re.IGNORECASE) for x in patterns)
    return [(hit(p["identifier_name_patterns"], n), hit(p["sensitive_name_patterns"], n)) for n in map(normalize, names)]


def _facts(table: Table) -> DataFrame:
    """What is known of each column without reading data."""
    rows = []
    for (i, _, f), (idn, sens) in zip(table.columns(), name_hints([f.name for f in table.fields], table.config), strict=True):
        m = f.metadata or {}
        rows.append((i, kind_of(f, table.config), isinstance(f.dataType, T.StringType), idn, sens, m.get("label") or None, len(m.get("labels") or {}), len(m["levels"]) if m.get("levels") is not None else None, m.get("units"), m.get("format"), f.dataType.simpleString(), tag_text(m.get("tags")), "; ".join(map(code_text, m["na_values"])) if m.get("na_values") else None, " to ".join(map(code_text, m["na_range"])) if m.get("na_range") else None))
    return table.df.sparkSession.createDataFrame(rows, "variable_position long, rule string, is_text boolean, id_hint boolean, sens_hint boolean, variable_label string, n_value_labels long, n_defined_factor_levels long, units string, source_display_format string, engine_type string, tagged_missing_summary string, user_missing_values string, user_missing_range string")


def tag_text(tags: dict[str, int] | None) -> str | None:
    """Counts of the tags of missing values, as their reader found them: the most frequent first, ties by tag."""
    return "; ".join(f"{t}={n}" for t, n in sorted(tags.items(), key=lambda x: (-x[1], x[0]))) if tags else None


def role_hints(table: Table, freq: DataFrame | None = None) -> DataFrame:
    """stats with potential_identifier, strong_identifier_evidence, potential_sensitive, long_text, role_hint_reason."""
    p = table.config["profiling"]
    freq = frequencies(table) if freq is None else freq
    s = stats(table, freq).join(F.broadcast(_facts(table)), "variable_position").join(pattern_ratios(table, freq), "variable_position", "left")
    email, phone, uuid = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("email_ratio", "phone_ratio", "uuid_ratio"))
    ratio = F.coalesce("uniqueness_ratio", F.lit(0.0))
    high = (ratio >= p["id_uniqueness_threshold"]) & (F.col("n_non_missing") >= p["id_min_non_missing"])
    short = F.col("string_mean_length").isNull() | (F.col("string_mean_length") <= p["id_max_mean_length"])
    limit = p["long_text_length_threshold"]
    long = F.coalesce((F.col("string_max_length") >= limit) | (F.col("string_mean_length") >= limit / 2), F.lit(False))
    strong = (F.col("id_hint") & (ratio >= 0.5)) | (F.col("sens_hint") & high) | (uuid >= 0.8)
    reasons = [(F.col("id_hint"), "identifier-like variable name"), (F.col("sens_hint"), "sensitive-data name pattern"), (email >= 0.5, "email-like values"), (phone >= 0.8, "phone-like values"), (uuid >= 0.8, "UUID-like values"), (high, "very high uniqueness")]
    why = F.nullif(F.concat_ws("; ", *[F.when(c, t) for c, t in reasons]), F.lit(""))
    return s.withColumns({"strong_identifier_evidence": strong, "potential_identifier": strong | (F.col("is_text") & high & short & ~long), "potential_sensitive": F.col("sens_hint") | (email >= 0.5) | (phone >= 0.8), "long_text": long, "role_hint_reason": why})


def cardinality_class(max_levels: int) -> Column:
    n = F.col("n_unique_non_missing")
    return (F.when(F.col("is_all_missing"), "all_missing").when(n == 1, "constant").when(n == 2, "binary").when(F.col("uniqueness_ratio") == 1, "all_unique").when(n <= max_levels, "low").when(n <= 50, "moderate").otherwise("high"))


def classified(table: Table, freq: DataFrame | None = None) -> DataFrame:
    """role_hints with semantic_type, measurement_level, categorical_eligible, classification_reason, cardinality_class."""
    p, n, r = table.config["profiling"], F.col("n_unique_non_missing"), F.col("rule")
    most, share = p["max_categorical_levels"], p["max_categorical_ratio"]
    ratio_ok = F.col("uniqueness_ratio").isNull() | (F.col("uniqueness_ratio") <= share)
    listed = (n <= most) & ratio_ok
    beyond = F.when(~ratio_ok, F.format_string(f" and uniqueness ratio %.3f exceeds {share:.3f}", "uniqueness_ratio")).otherwise("")
    text_type = F.when(F.col("strong_identifier_evidence"), "identifier").when(F.col("long_text"), "free_text").otherwise("high_cardinality_text")
    few = F.lit(p["numeric_low_cardinality_as_categorical"]) & (n <= p["numeric_max_categorical_levels"]) & (F.col("uniqueness_ratio").isNull() | (F.col("uniqueness_ratio") <= p["numeric_max_categorical_ratio"]))
    none = F.col("is_all_missing")
    number = r.isin("integer", "double")
    rules = [
        (r == "date", "date", "date", False, F.lit("Date class.")), (r == "datetime", "datetime", "datetime", False, F.lit("Date-time class.")), (r == "duration", "duration", "continuous", False, F.lit("Duration class.")),
        (r == "ordered", "ordered_categorical", "ordinal", True, F.format_string("Explicit ordered factor with %d observed distinct value(s).", n)),
        (r == "factor", "categorical", "nominal", True, F.format_string("Explicit factor with %d defined level(s).", "n_defined_factor_levels")),
        (r == "labelled", "labelled_categorical", "nominal", True, F.format_string("Imported labelled variable with %d value label(s).", "n_value_labels")),
        (r == "logical", "binary_categorical", "nominal", True, F.lit("Logical TRUE/FALSE variable.")),
        ((r == "text") & none, "text_all_missing", "text", False, F.lit("Character variable contains no nonblank values; categorical eligibility cannot be established.")),
        ((r == "text") & listed, "categorical", "nominal", True, F.format_string(f"Character variable has %d distinct nonmissing value(s), within the configured categorical limit of {most}.", n)),
        (r == "text", text_type, "text", False, F.concat(F.format_string(f"Character variable has %d distinct nonmissing value(s), exceeding the configured categorical limit of {most}", n), beyond, F.lit("; it is not treated as categorical."))),
        (number & few, "numeric_categorical", "nominal", True, F.lit("Numeric low-cardinality rule is enabled and its level and ratio limits were met.")),
        (r == "integer", "discrete_numeric", "discrete", False, F.lit("Integer variable without categorical labels.")), (r == "double", "continuous_numeric", "continuous", False, F.lit("Numeric variable without categorical labels.")),
        (r == "complex", "complex_numeric", "continuous", False, F.lit("Complex-number variable.")), (r == "nested", "nested_or_list", "nested", False, F.lit("Nested or list column.")), (r == "raw", "raw_binary", "binary_data", False, F.lit("Raw binary column.")),
    ]
    out = [r, F.lit("unknown"), F.lit(False), F.lit("No specific classification rule matched.")]
    for when, kind, level, eligible, reason in reversed(rules):
        values = (kind if isinstance(kind, Column) else F.lit(kind), F.lit(level), F.lit(eligible), reason)
        out = [F.when(when, v).otherwise(o) for v, o in zip(values, out, strict=True)]
    names = ("semantic_type", "measurement_level", "categorical_eligible", "classification_reason")
    return role_hints(table, freq).withColumns(dict(zip(names, out, strict=True)) | {"cardinality_class": cardinality_class(most)})
