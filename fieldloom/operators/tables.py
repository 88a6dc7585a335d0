"""The nineteen result tables: product, grain, purpose and columns, so that an empty table has its header too."""

from __future__ import annotations

from .dictionary import ORDER

_FILE = "source_file source_basename source_extension source_format source_format_description compression file_size_bytes file_size_human file_created_utc file_modified_utc file_accessed_utc file_status_changed_utc file_owner file_group file_permissions file_md5"
#: Result tables with their columns, in order.
COLUMNS = {
    "data_dictionary": " ".join(ORDER),
    "categorical_levels": "dataset_id variable_position variable_name level_order raw_value value_label display_value count percent_of_nonmissing percent_of_all is_missing is_other_unreported",
    "value_labels": "dataset_id variable_position variable_name label_order raw_value value_label",
    "dictionary_schema": "column_name definition",
    "documentation_gaps": "dataset_id variable_position variable_name gap_type severity message suggested_action",
    "run_metadata": "pipeline_name pipeline_version project_name run_comment started_utc completed_utc duration_seconds engine_version platform package_versions output_directory",
    "summary": "input_files supported_files files_read files_failed datasets variables dictionary_rows categorical_variables noncategorical_character_variables variables_missing_business_definition import_problems quality_issues errors",
    "administrative_metadata": "project_name project_description author data_owner data_steward source_system access_classification access_permissions license tags",
    "metadata_coverage": "metadata_category coverage_status primary_tables notes",
    "supported_formats": "family format extensions reader_package reader_function availability notes",
    "table_catalog": "artifact_group table_name grain purpose",
    "input_inventory": "source_file source_basename source_format supported status datasets_created error_message",
    "file_metadata": f"{_FILE} supported ingestion_status datasets_created",
    "dataset_metadata": "dataset_id dataset_name dataset_label source_file source_basename source_format source_format_description source_sheet source_object reader_package reader_function import_notes import_problem_count source_extension compression file_size_bytes file_size_human file_created_utc file_modified_utc file_owner file_group file_permissions file_md5 n_rows n_columns total_cells missing_cells percent_missing_cells blank_string_cells duplicate_rows percent_duplicate_rows duplicate_check_performed memory_bytes memory_human",
    "provenance_metadata": "dataset_id source_file source_sheet source_object source_format reader_package reader_function source_file_md5 imported_utc pipeline_name pipeline_version n_rows n_columns",
    "variable_metadata": "dataset_id variable_position variable_name source_variable_name variable_label engine_type storage_type source_display_format units semantic_type measurement_level categorical_eligible classification_reason cardinality_class n_rows n_non_missing n_system_missing n_missing percent_missing n_blank_strings n_unique_non_missing uniqueness_ratio is_all_missing is_constant is_all_unique potential_identifier strong_identifier_evidence potential_sensitive role_hint_reason n_value_labels n_defined_factor_levels tagged_missing_summary user_missing_values user_missing_range numeric_min numeric_q1 numeric_median numeric_mean numeric_q3 numeric_max numeric_sd n_infinite date_min date_max timezone string_min_length string_mean_length string_max_length n_leading_trailing_whitespace examples",
    "import_problems": "dataset_id source_file row col expected actual problem_file",
    "quality_issues": "dataset_id variable_position variable_name severity issue_type metric threshold message",
    "errors": "stage source_file dataset_id error_class error_message",
}
#: Products and grains. The purposes are this engine's own words.
CATALOG = (
    ("dictionary", "data_dictionary", "one row per variable", "What each field is, how it was classified, and what is still to be curated."),
    ("dictionary + metadata", "categorical_levels", "one row per reported level", "Counts and shares of the levels of categorical fields."),
    ("dictionary + metadata", "value_labels", "one row per imported code-label pair", "Codes and labels as the source defines them."),
    ("dictionary", "dictionary_schema", "one row per dictionary column", "What the dictionary's columns mean."),
    ("dictionary + metadata", "documentation_gaps", "one row per documentation/review gap", "Definitions and classifications that a person has to supply or confirm."),
    ("metadata", "run_metadata", "one row per run", "When, where and with which software the run took place."),
    ("metadata", "summary", "one row per run", "Counts of files, datasets, variables, issues and errors."),
    ("metadata", "administrative_metadata", "one row per run", "Ownership, access and license as configured."),
    ("metadata", "metadata_coverage", "one row per metadata category", "Which kinds of metadata the run has, and in which tables."),
    ("metadata", "supported_formats", "one row per supported format", "Formats, their readers and whether they are available."),
    ("metadata", "table_catalog", "one row per generated table", "This list of tables."),
    ("metadata", "input_inventory", "one row per discovered file", "Which files were found and what became of them."),
    ("metadata", "file_metadata", "one row per discovered file", "Size, times, owner and format of the files."),
    ("metadata", "dataset_metadata", "one row per imported dataset/sheet/object", "Shape, source and completeness of the datasets."),
    ("metadata", "provenance_metadata", "one row per imported dataset/sheet/object", "From which file and by which reader a dataset came."),
    ("metadata", "variable_metadata", "one row per variable", "All statistics of each variable."),
    ("metadata", "import_problems", "one row per reader parsing problem", "Records of delimited files that don't fit their header."),
    ("metadata", "quality_issues", "one row per quality flag", "What looks wrong, sensitive or incomplete in the data."),
    ("metadata", "errors", "one row per captured pipeline exception", "Files and datasets that failed while the run went on."),
)


def columns_of(name: str) -> list[str]:
    return COLUMNS[name].split()


def coverage(definitions_missing: int, admin_supplied: bool) -> list[dict]:
    """Which kinds of metadata there are. Categories, states and tables; the notes are this engine's own words."""
    rows = (
        ("structural", "captured", "dataset_metadata; variable_metadata; supported_formats", "Files, datasets, columns, types and sizes."),
        ("descriptive", "partial; documentation gaps reported" if definitions_missing else "definition candidates captured from source labels", "data_dictionary; categorical_levels; value_labels; documentation_gaps", f"Definitions are taken from labels only; {definitions_missing} field(s) still need one."),
        ("administrative", "supplied through configuration" if admin_supplied else "not supplied; fields retained as blank", "administrative_metadata", "Owner, access and license come from the configuration."),
        ("provenance", "captured", "file_metadata; provenance_metadata; run_metadata; resolved_config", "Source, reader, engine and time of each import."),
        ("quality", "captured", "quality_issues; import_problems; errors", "Completeness, parsing, repeats, privacy and other signals."),
    )
    return [dict(zip(columns_of("metadata_coverage"), r, strict=True)) for r in rows]
