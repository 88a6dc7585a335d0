"""What the columns of the data dictionary mean."""

from pyspark.sql import DataFrame, SparkSession

from .dictionary import ORDER

#: Definitions of the dictionary's columns.
DEFINITIONS = {
    "dataset_id": "Stable identifier for the imported dataset, worksheet, or object.",
    "dataset_name": "Dataset, worksheet-derived, or object-derived display name.",
    "label": "Variable label preserved from source metadata, when available.",
    "variable": "Dictionary field name used in the imported dataset.",
    "type": "Spark type after import.",
    "value_label": "Inline code-to-label mapping or categorical levels. Large mappings are previewed and stored completely in companion tables.",
    "value_representation": "Explains whether value_label contains mappings, factor levels, observed categories, or an exclusion message.",
    "value_domain_status": "Distinguishes source-defined or type-defined domains from values that were merely observed in the current data.",
    "n_missing": "Effective missing count, including blank strings when blank_as_missing is enabled.",
    "percent_missing": "Effective missing percentage.",
    "n_unique_non_missing": "Count of distinct nonmissing/nonblank values.",
    "categorical_eligible": "Whether the field qualifies for categorical treatment under the configured and source-defined rules.",
    "categorical_status": "Readable categorical decision, including the high-cardinality threshold result.",
    "semantic_type": "Inferred technical role such as categorical, identifier, free_text, date, or continuous_numeric.",
    "measurement_level": "Inferred measurement level such as nominal, ordinal, continuous, date, or text.",
    "business_definition": "Plain-language definition candidate copied from the source variable label when configured; otherwise left blank for curation.",
    "definition_source": "Origin of the business definition.",
    "documentation_status": "Whether a definition candidate is available and whether further curation is needed.",
    "technical_definition": "Automatically generated technical explanation based on observed structure and classification.",
    "inferred_validation_rules": "Observed constraints and ranges; these are not asserted as authoritative business rules.",
    "source_format": "Format of the source file.",
    "storage_type": "Underlying Spark storage type.",
    "source_display_format": "Imported display-format attribute, when available.",
    "units": "Imported units attribute, when available.",
    "nullable_observed": "TRUE when missing or configured blank values were observed.",
    "n_system_missing": "Count of native missing values before blank-string handling.",
    "n_blank_strings": "Count of blank or whitespace-only strings.",
    "potential_identifier": "Heuristic indicator that the field may identify records or people.",
    "potential_sensitive": "Heuristic indicator that the field may contain sensitive information.",
    "review_required": "TRUE when documentation, classification, identifier, or sensitivity review is recommended.",
    "review_reason": "Reasons for recommended review.",
    "classification_reason": "Exact rule and evidence used for technical classification.",
    "examples": "Representative values, subject to privacy masking.",
    "variable_position": "One-based source column position; disambiguates duplicate or blank names.",
    "source_variable_name": "Original source column name before display-name fallback.",
}


def schema_rows() -> list[dict]:
    """column_name, definition in the order of the dictionary."""
    return [{"column_name": name, "definition": DEFINITIONS[name]} for name in ORDER]


def dictionary_schema(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(r.values()) for r in schema_rows()], "column_name string, definition string")
