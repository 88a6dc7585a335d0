"""The data dictionary, documentation gaps and quality issues: one row per column, texts by cascades."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number_text
from .levels import categorical_levels, inline, value_labels
from .profile import Table, examples

TEXTUAL = ("high_cardinality_text", "free_text", "identifier")
#: First words of the technical definition.
TECHNICAL = {
    "date": "Date field", "datetime": "Date-time field", "duration": "Duration field", "ordered_categorical": "Ordered categorical field", "categorical": "Categorical field", "labelled_categorical": "Imported value-labelled categorical field",
    "binary_categorical": "Binary TRUE/FALSE field", "numeric_categorical": "Low-cardinality numeric categorical field", "discrete_numeric": "Discrete numeric field", "continuous_numeric": "Continuous numeric field", "identifier": "Identifier-like text field",
    "free_text": "Free-text field", "high_cardinality_text": "High-cardinality text field", "text_all_missing": "Text field with no observed nonblank values", "nested_or_list": "Nested or list-column field", "complex_numeric": "Complex-number field", "raw_binary": "Raw binary field",
}
ORDER = ("label", "variable", "type", "value_label", "n_missing", "dataset_id", "dataset_name", "value_representation", "value_domain_status", "percent_missing", "n_unique_non_missing", "categorical_eligible", "categorical_status", "semantic_type", "measurement_level", "business_definition", "definition_source", "documentation_status", "technical_definition", "inferred_validation_rules", "source_format", "storage_type", "source_display_format", "units", "nullable_observed", "n_system_missing", "n_blank_strings", "potential_identifier", "potential_sensitive", "review_required", "review_reason", "classification_reason", "examples", "variable_position", "source_variable_name")


def _cases(pairs: list[tuple[Column, Column | str]], last: Column | str | None) -> Column:
    out = F.lit(last) if last is None or isinstance(last, str) else last
    for when, then in reversed(pairs):
        out = F.when(when, then).otherwise(out)
    return out


def with_examples(table: Table, variables: DataFrame, freq: DataFrame | None = None) -> DataFrame:
    p = table.config["privacy"]
    if not p["include_examples"]:
        return variables.withColumn("examples", F.lit(None).cast("string"))
    hide = (F.lit(p["mask_potential_identifiers"]) & F.col("potential_identifier")) | (F.lit(p["mask_potential_sensitive"]) & F.col("potential_sensitive"))
    shown = F.when(F.col("n_non_missing") > 0, F.when(hide, p["masked_token"]).otherwise(F.col("shown")))
    return variables.join(examples(table, freq).withColumnRenamed("examples", "shown"), "variable_position", "left").withColumn("examples", shown).drop("shown")


def data_dictionary(table: Table, variables: DataFrame, dataset_id: str, freq: DataFrame | None = None) -> DataFrame:
    """35 columns, a row for each column of the table."""
    d, p, s = table.config["dictionary"], table.config["profiling"], F.col("semantic_type")
    labels = inline(value_labels(table).withColumn("t", F.concat("raw_value", F.lit(" = "), "value_label")), "label_order", "t", "by_label", d["inline_max_values"], d["preview_values"], "value_labels")
    levels = categorical_levels(table, variables, freq).filter("not is_missing and not is_other_unreported")
    levels = inline(levels, "level_order", "display_value", "by_level", d["inline_max_values"], d["preview_values"], "categorical_levels")
    v = (variables if "examples" in variables.columns else with_examples(table, variables, freq)).join(labels, "variable_position", "left").join(levels, "variable_position", "left")
    n = "n_unique_non_missing"
    status = _cases([
        ((s == "labelled_categorical"), F.format_string("Categorical: imported value-labelled field with %d label(s).", "n_value_labels")), ((s == "ordered_categorical"), F.format_string("Categorical: explicit ordered factor with %d defined level(s).", "n_defined_factor_levels")),
        ((s == "categorical") & F.col("n_defined_factor_levels").isNotNull(), F.format_string("Categorical: explicit factor with %d defined level(s).", "n_defined_factor_levels")), (F.col("categorical_eligible"), F.format_string("Categorical: %d observed distinct nonmissing value(s).", n)),
        (s.isin(*TEXTUAL), F.format_string(f"Not categorical: %d distinct nonblank value(s) exceed the configured limit of {p['max_categorical_levels']}.", n)), (s == "text_all_missing", "Not classified as categorical because no nonblank values were observed."),
    ], "Not applicable to this variable type.")
    has_labels, factor = F.col("n_value_labels") > 0, F.col("n_defined_factor_levels").isNotNull() & F.col("categorical_eligible")
    representation = _cases([(has_labels, "code = label mapping"), (factor, "defined factor levels"), (s == "binary_categorical", "logical values"), (F.col("categorical_eligible"), "observed categorical values"), (s.isin(*TEXTUAL), "high-cardinality character field; values intentionally not enumerated")], "not applicable")
    domain = _cases([(has_labels, "source-defined code-label mapping"), (factor, "source-defined factor domain"), (s == "binary_categorical", "type-defined logical domain"), (F.col("categorical_eligible"), "observed values only; not an authoritative allowed-value rule"), (s.isin(*TEXTUAL), "not enumerated because the field is not categorical")], "not applicable")
    label = F.nullif(F.trim("variable_label"), F.lit(""))
    definition = label if d["use_label_as_definition"] else F.lit(None).cast("string")
    words = F.create_map(*[F.lit(x) for x in chain(*TECHNICAL.items())])
    technical = F.concat(F.coalesce(F.element_at(words, s), F.concat(F.lit("Field classified as "), s)), F.lit(". "), "classification_reason")
    rules = F.concat_ws(
        " ", F.when(F.col("n_missing") > 0, "Missing values were observed.").otherwise("No missing values were observed."), F.when(F.col("categorical_eligible"), "Observed or defined categories are documented in the value/level tables."),
        F.when(s.isin(*TEXTUAL), f"Treat as text rather than a categorical field under the configured {p['max_categorical_levels']}-level rule."), F.concat(F.lit("Observed numeric range: "), number_text("numeric_min"), F.lit(" to "), number_text("numeric_max"), F.lit(".")),
        F.concat(F.lit("Observed date/time range: "), "date_min", F.lit(" to "), "date_max", F.lit(".")), F.concat(F.lit("Maximum observed text length: "), number_text("string_max_length"), F.lit(" character(s).")),
    )
    review = F.concat_ws("; ", F.when(definition.isNull(), "business definition is missing"), F.when(s.isin(*TEXTUAL), "non-categorical character classification should be reviewed"), F.when(F.col("potential_identifier"), "potential identifier"), F.when(F.col("potential_sensitive"), "potentially sensitive field"))
    out = v.withColumns({
        "label": label, "variable": F.col("variable_name"), "type": F.col("storage_type"), "value_label": F.coalesce("by_label", "by_level", F.when(s.isin(*TEXTUAL), status)), "dataset_id": F.lit(dataset_id), "dataset_name": F.lit(table.name), "value_representation": representation, "value_domain_status": domain,
        "categorical_status": status, "business_definition": definition, "definition_source": F.when(definition.isNotNull(), "source variable label (not independently validated)").otherwise("not supplied"),
        "documentation_status": F.when(definition.isNotNull(), "definition candidate available from source metadata").otherwise("needs business definition"), "technical_definition": technical, "inferred_validation_rules": rules if d["include_inferred_validation_rules"] else F.lit(None).cast("string"),
        "source_format": F.lit(table.source_format), "nullable_observed": F.col("n_missing") > 0, "review_required": review != "", "review_reason": F.nullif(review, F.lit("")),
    })
    return out.select(*ORDER)


def documentation_gaps(dictionary: DataFrame, flag_missing: bool = True) -> DataFrame:
    at = ["dataset_id", "variable_position", F.col("variable").alias("variable_name")]
    undefined = dictionary.filter(F.lit(flag_missing) & F.coalesce(F.trim("business_definition") == "", F.lit(True))).select(*at, F.lit("missing_business_definition").alias("gap_type"), F.lit("warning").alias("severity"), F.lit("No source variable label or curated business definition was available. The pipeline did not invent one.").alias("message"), F.lit("Add an authoritative plain-language definition and responsible owner/steward.").alias("suggested_action"))
    text = dictionary.filter(F.col("semantic_type").isin(*TEXTUAL)).select(*at, F.lit("classification_review").alias("gap_type"), F.lit("info").alias("severity"), F.col("categorical_status").alias("message"), F.lit("Confirm the field should remain text/identifier rather than be governed by a controlled category list.").alias("suggested_action"))
    return undefined.unionByName(text)


def variable_issues(table: Table, variables: DataFrame, dataset_id: str) -> DataFrame:
    """The issue rules of single columns."""
    p, n = table.config["profiling"], F.col("n_unique_non_missing")
    high, most = p["high_missingness_threshold"], p["max_categorical_levels"]
    names = [f.name for f in table.fields]
    twice = [i for i, _, f in table.columns() if names.count(f.name) > 1]

    def issue(when: Column, severity: Column | str, kind: str, metric: Column | None, threshold: float | None, message: Column | str) -> Column:
        text = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.when(when, F.struct(text(severity).alias("severity"), F.lit(kind).alias("issue_type"), (F.lit(None) if metric is None else metric).cast("double").alias("metric"), F.lit(threshold).cast("double").alias("threshold"), text(message).alias("message")))

    why = F.col("role_hint_reason")
    found = F.array(
        issue(F.col("is_all_missing"), "warning", "all_missing", F.lit(100), None, "All values are missing or blank."),
        issue(~F.col("is_all_missing") & (n == 1), "info", "constant", F.lit(1), 1, "Only one distinct nonmissing value was observed."),
        issue(F.col("percent_missing") / 100 >= high, "warning", "high_missingness", F.col("percent_missing"), 100 * high, F.format_string("Missingness is %.2f%%.", "percent_missing")),
        issue((F.col("rule") == "text") & ~F.col("categorical_eligible") & (n > most), "warning", "high_cardinality_character", n, most, F.col("classification_reason")),
        issue(F.col("potential_identifier"), F.when(F.col("strong_identifier_evidence"), "warning").otherwise("info"), "potential_identifier", 100 * F.col("uniqueness_ratio"), 100 * p["id_uniqueness_threshold"], F.concat(F.lit("Potential identifier: "), F.coalesce(why, F.lit("high uniqueness.")))),
        issue(F.col("potential_sensitive"), "warning", "potential_sensitive_data", None, None, F.concat(F.lit("Potentially sensitive field: "), F.coalesce(why, F.lit("name or value pattern.")))),
        issue(F.col("n_blank_strings") > 0, "info", "blank_strings", F.col("n_blank_strings"), None, F.format_string("%d blank string value(s) were treated as missing for profiling.", "n_blank_strings")),
        issue(F.lit(p["check_whitespace"]) & (F.col("n_leading_trailing_whitespace") > 0), "info", "leading_trailing_whitespace", F.col("n_leading_trailing_whitespace"), None, F.format_string("%d value(s) contain leading or trailing whitespace.", "n_leading_trailing_whitespace")),
        issue(F.lit(p["check_infinite_values"]) & (F.col("n_infinite") > 0), "warning", "infinite_numeric_values", F.col("n_infinite"), None, F.format_string("%d infinite numeric value(s) were observed.", "n_infinite")),
        issue(F.col("source_variable_name") == "", "warning", "blank_variable_name", None, None, "The source column name was blank; a display name was generated in the dictionary."),
        issue(F.col("variable_position").isin(*twice) if twice else F.lit(False), "warning", "duplicate_variable_name", None, None, F.format_string("The source name '%s' appears more than once; variable_position must be used to disambiguate it.", "source_variable_name")),
    )
    rows = variables.select(F.lit(dataset_id).alias("dataset_id"), "variable_position", "variable_name", F.explode(F.array_compact(found)).alias("x"))
    return rows.select("dataset_id", "variable_position", "variable_name", "x.*")


def dataset_issues(facts: DataFrame, p: dict) -> DataFrame:
    """Issues of whole datasets. facts: dataset_id, n_rows, duplicate_rows (null if not checked), import_problem_count."""
    n, d, most = F.col("import_problem_count"), F.col("duplicate_rows"), p["duplicate_check_max_rows"]
    rows = F.array_compact(F.array(
        F.when(n > 0, F.struct(F.lit("warning").alias("severity"), F.lit("import_parsing_problems").alias("issue_type"), n.cast("double").alias("metric"), F.lit(0.0).alias("threshold"), F.format_string("%d delimited-text parsing problem(s) were reported by the reader.", n).alias("message"))),
        F.when(d > 0, F.struct(F.lit("warning").alias("severity"), F.lit("duplicate_rows").alias("issue_type"), d.cast("double").alias("metric"), F.lit(0.0).alias("threshold"), F.format_string("%d row(s) are exact duplicates of an earlier row.", d).alias("message"))),
        F.when(F.lit(p["check_duplicate_rows"]) & d.isNull(), F.struct(F.lit("info").alias("severity"), F.lit("duplicate_check_skipped").alias("issue_type"), F.col("n_rows").cast("double").alias("metric"), F.lit(float(most)).alias("threshold"), F.lit("Exact duplicate-row checking was skipped because the dataset exceeded the configured row limit or contains unsupported nested values.").alias("message"))),
    ))
    return facts.select("dataset_id", F.lit(None).cast("long").alias("variable_position"), F.lit(None).cast("string").alias("variable_name"), F.explode(rows).alias("x")).select("dataset_id", "variable_position", "variable_name", "x.*")


def public_dictionary(dictionary: DataFrame) -> DataFrame:
    """Six readable columns without values of identifying or sensitive fields."""
    show = lambda c: F.when(F.col(c).isNull() | F.trim(c).isin("", "NA"), "-").otherwise(F.col(c))
    definition = F.when(show("business_definition") == "-", show("label")).otherwise(show("business_definition"))
    review = F.coalesce("potential_identifier", F.lit(False)) | F.coalesce("potential_sensitive", F.lit(False))
    open_values = F.col("value_representation").isin("code = label mapping", "defined factor levels", "type-defined logical domain", "logical values", "observed categorical values")
    kind = F.replace(F.when(show("measurement_level") == "-", show("semantic_type")).otherwise(show("measurement_level")), F.lit("_"), F.lit(" "))
    status = F.concat_ws("; ", F.when(definition == "-", "Definition needed"), F.when(review, "Disclosure review"))
    gone = F.concat(F.format_number("n_missing", 0), F.coalesce(F.concat(F.lit(" ("), F.format_string("%.1f", "percent_missing"), F.lit("%)")), F.lit("")))
    return dictionary.select(show("variable").alias("Variable"), definition.alias("Definition"), F.concat(F.upper(F.substring(kind, 1, 1)), F.substring(kind, 2, 1000)).alias("Type"), F.when(open_values & ~review, show("value_label")).otherwise("-").alias("Categories / values"), F.coalesce(gone, F.lit("-")).alias("Missing"), F.when(status == "", "Definition available").otherwise(status).alias("Status"))


def public_catalog(datasets: DataFrame) -> DataFrame:
    """Dataset (its label, else its name, else its identifier), Records, Variables: a row for each dataset of dataset_id, dataset_name, dataset_label, n_rows, n_columns."""
    known = lambda c: F.when(F.trim(c).isin("", "NA"), None).otherwise(F.col(c))
    count = lambda c: F.coalesce(F.format_number(c, 0), F.lit("-"))
    return datasets.select(F.coalesce(known("dataset_label"), known("dataset_name"), known("dataset_id"), F.lit("-")).alias("Dataset"), count("n_rows").alias("Records"), count("n_columns").alias("Variables"))


def public_totals(dictionary: DataFrame, datasets: DataFrame) -> DataFrame:
    """One row: datasets, variables, records, categorical_fields, definition_gaps, disclosure_flags, status."""
    flagged = F.coalesce("potential_identifier", F.lit(False)) | F.coalesce("potential_sensitive", F.lit(False))
    fields = dictionary.agg(F.count(F.lit(1)).alias("variables"), F.count_if(F.coalesce("categorical_eligible", F.lit(False))).alias("categorical_fields"), F.count_if(F.coalesce(F.trim("business_definition") == "", F.lit(True))).alias("definition_gaps"), F.count_if(flagged).alias("disclosure_flags"))
    whole = datasets.agg(F.count(F.lit(1)).alias("datasets"), F.sum("n_rows").alias("records"))
    # One row by one row.
    status = F.when((F.col("definition_gaps") > 0) | (F.col("disclosure_flags") > 0), "Draft \u2014 review before public release").otherwise("Prepared for publication review")
    return whole.crossJoin(fields).select("datasets", "variables", "records", "categorical_fields", "definition_gaps", "disclosure_flags", status.alias("status"))


def labelled_columns(dictionary: DataFrame) -> DataFrame:
    """The dictionary with a readable label in each field's metadata."""
    return dictionary.select(*[F.col(c).alias(c, metadata={"label": LABELS[c]}) if c in LABELS else F.col(c) for c in dictionary.columns])


#: Readable labels of the dictionary's columns.
LABELS = {
    "dataset_id": "Dataset Identifier", "dataset_name": "Dataset Name", "label": "Variable Label", "variable": "Variable Name", "type": "Variable Type", "value_label": "Value Labels or Levels", "value_representation": "Value Representation", "value_domain_status": "Value Domain Authority",
    "n_missing": "Number Missing per Variable", "percent_missing": "Percent Missing", "n_unique_non_missing": "Distinct Nonmissing Values", "categorical_eligible": "Categorical Eligible", "categorical_status": "Categorical Decision", "semantic_type": "Semantic Type", "measurement_level": "Measurement Level",
    "business_definition": "Business Definition", "definition_source": "Definition Source", "documentation_status": "Documentation Status", "technical_definition": "Technical Definition", "inferred_validation_rules": "Observed or Inferred Rules", "source_format": "Source Format", "storage_type": "Storage Type",
    "source_display_format": "Source Display Format", "units": "Units", "nullable_observed": "Missingness Observed", "n_system_missing": "Native Missing Count", "n_blank_strings": "Blank String Count", "potential_identifier": "Potential Identifier", "potential_sensitive": "Potential Sensitive Field",
    "review_required": "Review Required", "review_reason": "Review Reason", "classification_reason": "Classification Reason", "examples": "Representative Values", "variable_position": "Variable Position", "source_variable_name": "Source Variable Name",
}
