"""Categorical levels, value labels, and their inline texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import code_text
from .profile import NUMERIC, Table, frequencies

LEVELS = "variable_position long, variable_name string, level_order long, raw_value string, value_label string, display_value string, count long, percent_of_nonmissing double, percent_of_all double, is_missing boolean, is_other_unreported boolean"


def value_labels(table: Table) -> DataFrame:
    """A row for each code-label pair of the fields' metadata."""
    rows = [(i, table.display(i), k + 1, code_text(code) if isinstance(f.dataType, NUMERIC) else str(code), label) for i, _, f in table.columns() for k, (code, label) in enumerate(((f.metadata or {}).get("labels") or {}).items())]
    return table.df.sparkSession.createDataFrame(rows, "variable_position long, variable_name string, label_order long, raw_value string, value_label string")


def defined_levels(table: Table) -> DataFrame:
    """Values that a factor or boolean has by definition, in their order."""
    rows = []
    for i, _, f in table.columns():
        own = (f.metadata or {}).get("levels")
        own = ["FALSE", "TRUE"] if own is None and isinstance(f.dataType, T.BooleanType) else own or []
        rows += [(i, v, k) for k, v in enumerate(own)]
    return table.df.sparkSession.createDataFrame(rows, "variable_position long, value string, defined long")


def categorical_levels(table: Table, variables: DataFrame, freq: DataFrame | None = None) -> DataFrame:
    """Levels of the eligible columns: by count, then text (defined domains in their order, zero counts too); capped, with a row for the rest and one for missing values.

    variables is read here once (a row for each column), so that only the eligible columns are counted; freq, if given,
    has whole texts of those.
    """
    rows = variables.select("variable_position", "variable_name", "n_rows", "n_non_missing", "n_missing", "categorical_eligible").collect()
    spark = table.df.sparkSession
    own = spark.createDataFrame([tuple(r)[:5] for r in rows if r["categorical_eligible"]], "variable_position long, variable_name string, n_rows long, n_non_missing long, n_missing long")
    eligible = [r["variable_position"] for r in rows if r["categorical_eligible"]]
    p = table.config["profiling"]
    most = p["max_levels_reported"]
    seen = (frequencies(table, eligible, True) if freq is None else freq).select("variable_position", "value", "n").filter(F.col("variable_position").isin(*eligible))
    both = seen.join(defined_levels(table), ["variable_position", "value"], "full").withColumn("n", F.coalesce("n", F.lit(0)))
    order = Window.partitionBy("variable_position").orderBy(F.col("defined").asc_nulls_last(), F.desc("n"), "value")
    placed = both.join(F.broadcast(own), "variable_position").withColumn("level_order", F.row_number().over(order).cast("long"))
    labels = value_labels(table).filter("trim(value_label) != ''").select("variable_position", F.col("raw_value").alias("value"), "value_label").dropDuplicates(["variable_position", "value"])
    of_all, of_some = F.when(F.col("n_rows") > 0, 100.0 * F.col("n") / F.col("n_rows")), F.when(F.col("n_non_missing") > 0, 100.0 * F.col("n") / F.col("n_non_missing"))
    shape = ["variable_position", "variable_name", "level_order", F.col("value").alias("raw_value"), "value_label", F.coalesce(F.concat("value", F.lit(" — "), "value_label"), "value").alias("display_value"), F.col("n").alias("count"), of_some.alias("percent_of_nonmissing"), of_all.alias("percent_of_all")]
    reported = placed.filter(F.col("level_order") <= most).join(labels, ["variable_position", "value"], "left").select(*shape, F.lit(False).alias("is_missing"), F.lit(False).alias("is_other_unreported"))
    rest = placed.filter(F.col("level_order") > most).groupBy("variable_position", "variable_name", "n_rows", "n_non_missing").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("more"))
    rest = rest.withColumns({"value": F.lit("<OTHER_UNREPORTED>"), "value_label": F.format_string("%d additional level(s)", "more"), "level_order": F.lit(most + 1).cast("long")}).select(*shape[:5], F.col("value_label").alias("display_value"), *shape[6:], F.lit(False), F.lit(True))
    out = reported.union(rest)
    if p["include_missing_level"]:
        ends = out.groupBy("variable_position").agg(F.max("level_order").alias("last"))
        gone = own.filter("n_missing > 0").join(ends, "variable_position", "left").withColumns({"n": F.col("n_missing"), "value": F.lit("<MISSING>"), "value_label": F.lit(None).cast("string"), "level_order": F.coalesce("last", F.lit(0)) + 1})
        out = out.union(gone.select(*shape[:7], F.lit(None).cast("double"), of_all, F.lit(True), F.lit(False)))
    return out


def inline(entries: DataFrame, order: str, text: str, name: str, most: int, preview: int, companion: str) -> DataFrame:
    """variable_position and the entries joined by "; ": all up to most, else a preview with the total."""
    listed = entries.groupBy("variable_position").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("l"))
    texts = F.transform("l", lambda s: s["t"])
    more = F.format_string(f"; ... [%d total; complete values in {companion}]", F.size("l"))
    return listed.select("variable_position", F.when(F.size("l") <= most, F.array_join(texts, "; ")).otherwise(F.concat(F.array_join(F.slice(texts, 1, preview), "; "), more)).alias(name))
