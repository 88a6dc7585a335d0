"""Settings: defaults, deep merge of overrides, validation."""

from __future__ import annotations

from copy import deepcopy
from typing import Any

#: The default settings and name patterns.
DEFAULTS: dict[str, Any] = {
    "input": {"recursive": False, "include_hidden": False, "continue_on_error": True, "excel_sheets": "all", "r_objects": "all", "text_delimiter": "\t", "text_encoding": "UTF-8", "n_max": None, "sas_catalog": None, "auto_sas_catalog": True, "allow_unsafe_pickle": False, "compute_md5": False},
    "profiling": {
        "blank_as_missing": True, "max_categorical_levels": 10, "max_categorical_ratio": 1.0, "factor_always_categorical": True, "labelled_always_categorical": True, "logical_as_categorical": True,
        "numeric_low_cardinality_as_categorical": False, "numeric_max_categorical_levels": 10, "numeric_max_categorical_ratio": 0.05, "id_uniqueness_threshold": 0.98, "id_min_non_missing": 10, "id_max_mean_length": 80,
        "long_text_length_threshold": 100, "sample_values": 5, "max_levels_reported": 50, "include_missing_level": True, "include_level_frequencies": True, "include_quantiles": True, "high_missingness_threshold": 0.50,
        "check_duplicate_rows": True, "duplicate_check_max_rows": 100000, "check_whitespace": True, "check_infinite_values": True,
    },
    "dictionary": {"inline_max_values": 10, "preview_values": 5, "use_label_as_definition": True, "include_inferred_validation_rules": True, "flag_missing_definitions": True},
    "metadata": {"project_name": None, "project_description": None, "author": None, "data_owner": None, "data_steward": None, "source_system": None, "access_classification": None, "access_permissions": None, "license": None, "run_comment": None, "tags": []},
    "privacy": {
        "include_examples": True, "mask_potential_identifiers": True, "mask_potential_sensitive": True, "masked_token": "<masked>",
        "identifier_name_patterns": ["(^|_)(id|key|uuid|guid|record_number|row_number|case_number|reference_number|account_number)(_|$)", "(^|_)(code|number|no)$"],
        "sensitive_name_patterns": ["(^|_)(name|first_name|last_name|full_name|email|e_mail|phone|mobile|telephone)(_|$)", "(^|_)(address|street|postcode|postal_code|zip|ssn|national_id|passport)(_|$)", "(^|_)(dob|birth_date|date_of_birth|patient|client|customer|employee)(_|$)"],
    },
    "output": {"write_csv": True, "write_json": True, "write_excel": True, "write_html": True, "overwrite": False, "html_max_rows_per_table": 5000},
}
_AT_LEAST_ONE = (("profiling", "max_categorical_levels"), ("profiling", "id_min_non_missing"), ("profiling", "max_levels_reported"), ("profiling", "numeric_max_categorical_levels"), ("dictionary", "inline_max_values"), ("dictionary", "preview_values"))
_SHARES = ("max_categorical_ratio", "numeric_max_categorical_ratio", "id_uniqueness_threshold", "high_missingness_threshold")


def merged(base: dict, override: dict | None) -> dict:
    """Nested maps merge; anything else replaces; None keeps the base."""
    out = deepcopy(base)
    for k, v in (override or {}).items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k] = merged(out[k], v)
        elif v is not None:
            out[k] = v
    return out


def validated(config: dict) -> dict:
    missing = [s for s in DEFAULTS if not isinstance(config.get(s), dict)]
    if missing:
        raise ValueError(f"configuration lacks sections: {', '.join(missing)}")
    for section, key in _AT_LEAST_ONE:
        if config[section][key] < 1:
            raise ValueError(f"{section}.{key} must be at least 1")
    for key in _SHARES:
        if not 0 <= config["profiling"][key] <= 1:
            raise ValueError(f"profiling.{key} must be between 0 and 1")
    if config["profiling"]["sample_values"] < 0:
        raise ValueError("profiling.sample_values must not be negative")
    if config["dictionary"]["preview_values"] > config["dictionary"]["inline_max_values"]:
        raise ValueError("dictionary.preview_values must not exceed inline_max_values")
    if len(config["input"]["text_delimiter"]) != 1:
        raise ValueError("input.text_delimiter must be one character")
    return config


def load(override: dict | str | None = None, cli: dict | None = None) -> dict:
    """Defaults, then a map or YAML file, then command-line settings."""
    if isinstance(override, str):
        import yaml

        with open(override, encoding="utf-8") as f:
            override = yaml.safe_load(f) or {}
    return validated(merged(merged(DEFAULTS, override), cli))
