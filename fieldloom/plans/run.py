"""From files to the nineteen result tables and their artifacts."""

from __future__ import annotations

import csv
import datetime as dt
import html
import os
import platform
import shutil
import time
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice
from xml.sax.saxutils import escape, quoteattr

import pyspark
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import load
from ..functions.columns import group_of, slugify
from ..operators.classify import classified
from ..operators.dictionary import data_dictionary, dataset_issues, documentation_gaps, labelled_columns, public_catalog, public_dictionary, public_totals, variable_issues, with_examples
from ..operators.levels import categorical_levels, value_labels
from ..operators.profile import Table, dataset_cells, duplicate_rows, frequencies, union_fill, with_quartiles
from ..operators.schema import schema_rows
from ..operators.tables import CATALOG, COLUMNS, columns_of, coverage
from ..sources import files

PIPELINE, VERSION = "data_dictionary", "2.0.0"


def profile(df: DataFrame, name: str = "data", config: dict | None = None, dataset_id: str | None = None, source_format: str = "in_memory", label: str | None = None, import_problems: int = 0) -> dict[str, DataFrame]:
    """Tables about one DataFrame (its columns' statistics are computed here, the rest is lazy): variable_metadata, categorical_levels, value_labels, data_dictionary, documentation_gaps, quality_issues, dataset_metadata."""
    table = Table(df, name, config, source_format, label)
    c, dataset_id = table.config, dataset_id or slugify(name)
    freq = frequencies(table)
    found = with_quartiles(table, with_examples(table, classified(table, freq), freq))
    # A row for each column: everything below is derived from these few rows, not from further scans.
    rows = found.collect()
    variables = df.sparkSession.createDataFrame(rows, found.schema)
    freq = frequencies(table, [r["variable_position"] for r in rows if r["categorical_eligible"]], whole=True)
    dictionary = data_dictionary(table, variables, dataset_id, freq)
    p, key = c["profiling"], F.lit(dataset_id).alias("dataset_id")
    # None: no limit. The count of rows decides whether duplicates are looked for.
    most = p["duplicate_check_max_rows"]
    n_rows = rows[0]["n_rows"] if rows else df.count()
    twice, checked = None, False
    if p["check_duplicate_rows"] and (most is None or n_rows <= most):
        try:
            twice, checked = duplicate_rows(df).first()["duplicate_rows"], True
        except AnalysisException:  # a type whose values can't be compared
            twice = None
    cells = dataset_cells(table, variables).withColumns({"n_rows": F.lit(n_rows).cast("long"), "duplicate_rows": F.lit(twice).cast("long")})
    facts = cells.select(key, F.lit(name).alias("dataset_name"), F.lit(label).cast("string").alias("dataset_label"), F.lit(source_format).alias("source_format"), F.lit(import_problems).cast("long").alias("import_problem_count"), F.col("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"), "total_cells", "missing_cells", "percent_missing_cells", "blank_string_cells", "duplicate_rows", F.when(F.col("n_rows") > 0, 100.0 * F.col("duplicate_rows") / F.col("n_rows")).alias("percent_duplicate_rows"), F.lit(checked).alias("duplicate_check_performed"))
    return {
        "variable_metadata": variables.select(key, "*"), "categorical_levels": categorical_levels(table, variables, freq).select(key, "*"), "value_labels": value_labels(table).select(key, "*"), "data_dictionary": dictionary, "documentation_gaps": documentation_gaps(dictionary, c["dictionary"]["flag_missing_definitions"]),
        "quality_issues": union_fill([variable_issues(table, variables, dataset_id), dataset_issues(facts, p)]), "dataset_metadata": facts,
    }


def dictionary_of(df: DataFrame, max_categorical_levels: int = 10, dataset_id: str = "data", dataset_name: str | None = None) -> DataFrame:
    """The data dictionary of a DataFrame, without any file."""
    config = load({"profiling": {"max_categorical_levels": max_categorical_levels, "check_duplicate_rows": False}, "dictionary": {"inline_max_values": max_categorical_levels, "preview_values": min(5, max_categorical_levels)}})
    return labelled_columns(profile(df, dataset_name or dataset_id, config, dataset_id, "in_memory")["data_dictionary"])


class Problems(Sequence):
    """All parsing problems of all datasets as rows, streamed from their files a partition at a time: they are never on the driver together. Slices are lists."""

    names = tuple(columns_of("import_problems"))

    def __init__(self) -> None:
        self.parts: list[tuple[DataFrame, str, int]] = []

    def add(self, df: DataFrame, dataset_id: str, n: int) -> None:
        self.parts.append((df, dataset_id, n))

    def __len__(self) -> int:
        return sum(n for *_, n in self.parts)

    def __iter__(self) -> Iterator[dict]:
        for df, dataset_id, n in self.parts:
            if n:
                yield from ({"dataset_id": dataset_id} | r.asDict() for r in df.toLocalIterator())

    def __getitem__(self, at: int | slice) -> dict | list[dict]:
        if isinstance(at, slice):
            first, end, step = at.indices(len(self))
            return list(islice(self, first, end, step)) if step > 0 else list(self)[at]
        if not -len(self) <= at < len(self):
            raise IndexError(at)
        return next(islice(self, at % len(self), None))


def dataset_ids(datasets: list[files.Dataset]) -> None:
    """stem__sheet__object[__name] as a slug; repeats get __1, __2 ... where free."""
    used: set[str] = set()
    for d in datasets:
        parts = [files.stem(d.source_file), d.sheet, d.object]
        base = slugify("__".join(p for p in parts if p) or d.name, "dataset")
        name, k = base, 0
        while name in used:
            k += 1
            name = f"{base}__{k}"
        used.add(name)
        d.dataset_id = name


def run(spark: SparkSession, inputs: list[str], output: str | None = None, config: dict | str | None = None, cli: dict | None = None) -> dict[str, Sequence[dict]]:
    """The nineteen tables, as rows (they have a row for a column, file or issue; import_problems, with a row for each bad line, is streamed), exported if output is given."""
    c, began = load(config, cli), time.time()
    paths = files.discover(inputs, c["input"]["recursive"], c["input"]["include_hidden"])
    if not paths:
        raise FileNotFoundError("no input files were found")
    problems = Problems()
    t: dict[str, Sequence[dict]] = {name: [] for _, name, *_ in CATALOG} | {"import_problems": problems}
    datasets: list[files.Dataset] = []

    def failed(stage: str, path: str, dataset: str | None, e: Exception) -> None:
        if not c["input"]["continue_on_error"]:
            raise e
        t["errors"].append({"stage": stage, "source_file": path, "dataset_id": dataset, "error_class": type(e).__name__, "error_message": str(e)[:2000]})

    for path in paths:
        kind, aux, own, error = files.detect_format(path), files.is_auxiliary(path), [], None
        if kind and not aux:
            try:
                own = files.read_source(spark, path, c)
            except Exception as e:
                error = e
                failed("ingestion", path, None, e)
        status = "auxiliary" if aux else "skipped_unsupported" if not kind else "failed" if error else "read"
        facts = files.file_metadata(path, c["input"]["compute_md5"]) | {"supported": bool(kind), "ingestion_status": status, "datasets_created": len(own)}
        t["file_metadata"].append(facts)
        t["input_inventory"].append({"source_file": path, "source_basename": os.path.basename(path), "source_format": kind, "supported": bool(kind), "status": status, "datasets_created": len(own), "error_message": str(error)[:2000] if error else None})
        for d in own:
            d.file_metadata = facts
        datasets += own
    dataset_ids(datasets)
    for d in datasets:
        try:
            # Every problem has an `actual`; a count of rows alone would read the corrupt lines alone, which Spark refuses.
            n_problems = d.problems.agg(F.count("actual")).first()[0] if d.problems is not None else 0
            tables = {k: [r.asDict() for r in v.collect()] for k, v in profile(d.df, d.name, c, d.dataset_id, d.source_format, d.label, n_problems).items()}
        except Exception as e:
            failed("profiling", d.source_file, d.dataset_id, e)
            continue
        for k, rows in tables.items():
            t[k] += rows
        if d.problems is not None:
            problems.add(d.problems, d.dataset_id, n_problems)
        one = t["dataset_metadata"][-1]
        package, function = files.READER_OF.get(d.source_format, (None, None))
        size = float(str(d.df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # the planner's estimate; nothing is held in memory
        one |= {k: d.file_metadata.get(k) for k in columns_of("dataset_metadata") if k in d.file_metadata and k not in one}
        one |= {"source_file": d.source_file, "source_sheet": d.sheet, "source_object": d.object, "import_notes": d.notes, "reader_package": package, "reader_function": function, "memory_bytes": size, "memory_human": files.human(size)}
        t["provenance_metadata"].append({k: one.get(k) for k in columns_of("provenance_metadata")} | {"source_file_md5": one["file_md5"], "imported_utc": now(), "pipeline_name": PIPELINE, "pipeline_version": VERSION})
    m, n = c["metadata"], lambda k, f=lambda r: True: sum(map(bool, map(f, t[k])))
    t["dictionary_schema"] = schema_rows()
    t["administrative_metadata"] = [{k: "; ".join(map(str, v)) or None if isinstance(v, list) else v for k, v in m.items() if k != "run_comment"}]
    t["supported_formats"] = [dict(zip(("family", "format", "extensions", "availability"), f, strict=True)) | dict(zip(("reader_package", "reader_function"), files.READER_OF.get(f[1], (None, None)), strict=True)) | {"notes": files.NOTES.get(f[1])} for f in files.FORMATS]
    t["table_catalog"] = [dict(zip(columns_of("table_catalog"), r, strict=True)) for r in CATALOG]
    missing = n("data_dictionary", lambda r: not (r["business_definition"] or "").strip())
    t["metadata_coverage"] = coverage(missing, any(str(v or "").strip() for v in t["administrative_metadata"][0].values()))
    t["run_metadata"] = [{"pipeline_name": PIPELINE, "pipeline_version": VERSION, "project_name": m["project_name"], "run_comment": m["run_comment"], "started_utc": now(began), "completed_utc": now(), "duration_seconds": time.time() - began, "engine_version": f"pyspark {pyspark.__version__}", "platform": platform.platform(), "package_versions": packages(), "output_directory": output and os.path.abspath(output)}]
    t["summary"] = [{
        "input_files": len(paths), "supported_files": n("input_inventory", lambda r: r["supported"]), "files_read": n("input_inventory", lambda r: r["status"] == "read"), "files_failed": n("input_inventory", lambda r: r["status"] == "failed"), "datasets": n("dataset_metadata"), "variables": n("variable_metadata"), "dictionary_rows": n("data_dictionary"),
        "categorical_variables": n("data_dictionary", lambda r: r["categorical_eligible"]), "noncategorical_character_variables": n("data_dictionary", lambda r: r["semantic_type"] in ("high_cardinality_text", "free_text", "identifier")), "variables_missing_business_definition": n("data_dictionary", lambda r: not r["business_definition"]),
        "import_problems": len(problems), "quality_issues": n("quality_issues"), "errors": n("errors"),
    }]
    # Every table has its columns in their order, whatever its rows brought.
    for name in t:
        if name != "import_problems":
            t[name] = [{k: r.get(k) for k in columns_of(name)} for r in t[name]]
    if output:
        export(t, output, c)
    return t


def packages() -> str:
    """Versions of what reads and writes files."""
    from importlib.metadata import PackageNotFoundError, version

    found = []
    for name in ("pyspark", "pyarrow", "pandas", "numpy", "PyYAML"):
        try:
            found.append(f"{name} {version(name)}")
        except PackageNotFoundError:
            continue
    return "; ".join(found)


def now(at: float | None = None) -> str:
    return dt.datetime.fromtimestamp(time.time() if at is None else at, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


#: What an export may find and replace in its folder.
OWN = ("csv", "data_dictionary.json", "metadata.json", "data_dictionary.xlsx", "metadata.xlsx", "metadata_report.html", "open_science_metadata_report.html", "resolved_config.yml", "artifact_manifest.csv")


def prepared(output: str, overwrite: bool) -> None:
    if os.path.isdir(output) and os.listdir(output) and not overwrite:
        raise FileExistsError(f"{output} isn't empty; output.overwrite replaces earlier artifacts")
    os.makedirs(output, exist_ok=True)
    for name in OWN:
        path = os.path.join(output, name)
        shutil.rmtree(path) if os.path.isdir(path) else os.path.exists(path) and os.remove(path)


def names_of(rows: Sequence[dict], name: str | None = None) -> list[str]:
    """Of the table of that name, or else of all rows' members."""
    return columns_of(name) if name in COLUMNS else list(rows.names) if isinstance(rows, Problems) else list(dict.fromkeys(k for r in rows for k in r))


def text_of(x: object) -> str:
    return "" if x is None else str(x).upper() if isinstance(x, bool) else str(x)


def write_csv(path: str, rows: Sequence[dict], name: str | None = None) -> None:
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, names_of(rows, name))
        out.writeheader()
        out.writerows({k: text_of(v) for k, v in r.items()} for r in rows)


def write_json(path: str, members: dict[str, object]) -> None:
    """One object; tables are written row by row."""
    with open(path, "w", encoding="utf-8") as f:
        for i, (name, value) in enumerate(members.items()):
            f.write(f"{', ' if i else '{'}{files.to_json(name)}: ")
            if not isinstance(value, Problems):
                f.write(files.to_json(value))
                continue
            f.write("[")
            f.writelines(", " * bool(k) + files.to_json(r) for k, r in enumerate(value))
            f.write("]")
        f.write("}")


#: Rows that a sheet of a workbook can hold below its header.
SHEET_ROWS = 1_048_575


def write_xlsx(path: str, tables: dict[str, Sequence[dict]]) -> None:
    """Inline strings, bold header, filter, frozen first row, widths from the first 200 rows. A table beyond a sheet's rows goes on in the next sheet."""
    def letters(i: int) -> str:
        return (letters(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)

    taken: set[str] = set()
    sheets = []
    for name, rows, first in ((name, rows, first) for name, rows in tables.items() for first in range(0, len(rows) or 1, SHEET_ROWS)):
        base = "".join("_" if ch in "[]:*?/\\" else ch for ch in name)[:31]
        title, k = base, 1
        while title.lower() in taken:
            k += 1
            title = f"{base[: 31 - len(str(k)) - 1]}_{k}"
        taken.add(title.lower())
        sheets.append((title, names_of(rows, name), rows, first))
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{over}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + f'<Relationship Id="s" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name={quoteattr(t)} sheetId="{i}" r:id="r{i}"/>' for i, (t, *_) in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="3"><fill/><fill/><fill><patternFill patternType="solid"><fgColor rgb="FFFFF2CC"/></patternFill></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf fontId="1" applyFont="1"/><xf fillId="2" applyFill="1"/></cellXfs></styleSheet>')
        for i, (_, names, rows, first) in enumerate(sheets, 1):
            cell = lambda r, j, v, s: f'<c r="{letters(j)}{r}" s="{s}"><v>{v}</v></c>' if isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) != float("inf") else "" if v is None else f'<c r="{letters(j)}{r}" s="{s}" t="inlineStr"><is><t xml:space="preserve">{escape("".join(ch for ch in text_of(v) if ch >= " " or ch in chr(9) + chr(10)))}</t></is></c>'
            top, here = rows[:200], min(len(rows) - first, SHEET_ROWS)
            widths = "".join(f'<col min="{j + 1}" max="{j + 1}" width="{min(60, max(10, 2 + max([len(n), *(len(text_of(r.get(n))) for r in top)])))}" customWidth="1"/>' for j, n in enumerate(names))
            filter_ = f'<autoFilter ref="A1:{letters(len(names) - 1)}{here + 1}"/>' if names else ""
            with z.open(f"xl/worksheets/sheet{i}.xml", "w", force_zip64=isinstance(rows, Problems)) as f:
                put = lambda x, f=f: f.write(x.encode())
                put(f'<?xml version="1.0"?><worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>{f"<cols>{widths}</cols>" if names else ""}<sheetData>')
                put(f'<row r="1">{"".join(cell(1, j, n, 1) for j, n in enumerate(names))}</row>')
                for k, r in enumerate(islice(rows, first, first + SHEET_ROWS), 2):
                    put(f'<row r="{k}">{"".join(cell(k, j, r.get(n), 2 if r.get("review_required") is True else 0) for j, n in enumerate(names))}</row>')
                put(f"</sheetData>{filter_}</worksheet>")


def html_table(rows: Sequence[dict], most: int) -> str:
    names, e = names_of(rows), lambda x: html.escape(text_of(x), quote=True)
    head = "".join(f"<th>{e(n)}</th>" for n in names)
    body = "".join("<tr>" + "".join(f"<td>{e(r.get(n))}</td>" for n in names) + "</tr>" for r in rows[:most])
    more = f"<p>{len(rows) - most} more rows are in the CSV tables.</p>" if len(rows) > most else ""
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>{more}" if rows else "<p>No rows.</p>"


def _page(title: str, parts: list[tuple[str, str]]) -> str:
    style = "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:.3em;text-align:left}"
    return f"<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>{html.escape(title)}</title><style>{style}</style></head><body><h1>{html.escape(title)}</h1>" + "".join(f"<h2>{html.escape(h)}</h2>{b}" for h, b in parts) + "</body></html>"


def public_rows(dictionary: list[dict]) -> list[dict]:
    """The public dictionary from collected rows, by the same operator."""
    from pyspark.sql import SparkSession as S

    spark = S.getActiveSession()
    schema = "variable string, business_definition string, label string, potential_identifier boolean, potential_sensitive boolean, value_representation string, value_label string, measurement_level string, semantic_type string, n_missing long, percent_missing double"
    names = [f.split()[0] for f in schema.split(", ")]
    return [r.asDict() for r in public_dictionary(spark.createDataFrame([tuple(r[n] for n in names) for r in dictionary], schema)).collect()]


def public_overview(t: dict[str, Sequence[dict]], most: int) -> list[tuple[str, str]]:
    """Totals, what is still to be reviewed, the catalog of datasets and what is known of the project; no path, owner or value of a field."""
    from pyspark.sql import SparkSession as S

    spark = S.getActiveSession()
    datasets = spark.createDataFrame([tuple(d.get(k) for k in ("dataset_id", "dataset_name", "dataset_label", "n_rows", "n_columns")) for d in t["dataset_metadata"]], "dataset_id string, dataset_name string, dataset_label string, n_rows long, n_columns long")
    fields = spark.createDataFrame([tuple(r[k] for k in ("business_definition", "potential_identifier", "potential_sensitive", "categorical_eligible")) for r in t["data_dictionary"]], "business_definition string, potential_identifier boolean, potential_sensitive boolean, categorical_eligible boolean")
    totals = public_totals(fields, datasets).first().asDict()
    shown = [{"Total": k.replace("_", " ").capitalize(), "Value": v if isinstance(v, str) else "-" if v is None else f"{v:,}"} for k, v in totals.items()]
    project = [{"Field": k.replace("_", " ").capitalize(), "Value": v} for k, v in t["administrative_metadata"][0].items() if v and k not in ("data_owner", "data_steward", "source_system")]
    review = f"<p>{totals['definition_gaps']:,} definition gap(s); {totals['disclosure_flags']:,} field(s) flagged for disclosure review. Flags are prompts for a person to confirm.</p>"
    return [("Overview", html_table(shown, most) + review), ("Project", html_table(project, most)), ("Datasets", html_table([r.asDict() for r in public_catalog(datasets).collect()], most))]


def export(t: dict[str, Sequence[dict]], output: str, c: dict) -> None:
    import yaml

    o = c["output"]
    prepared(output, o["overwrite"])
    at = lambda *p: os.path.join(output, *p)
    parts = {p: {name: t[name] for group, name, *_ in CATALOG if p in group} for p in ("dictionary", "metadata")}
    with open(at("resolved_config.yml"), "w", encoding="utf-8") as f:
        yaml.safe_dump(c, f, sort_keys=False)
    if o["write_csv"]:
        os.makedirs(at("csv"))
        for name, rows in t.items():
            write_csv(at("csv", f"{name}.csv"), rows, name)
        write_csv(at("csv", "variable_dictionary.csv"), t["data_dictionary"], "data_dictionary")
    if o["write_json"]:
        for name, extra in (("data_dictionary", {}), ("metadata", {"resolved_config": c})):
            write_json(at(f"{name}.json"), {"concept": name, **parts["dictionary" if name == "data_dictionary" else "metadata"], **extra})
    if o["write_excel"]:
        write_xlsx(at("data_dictionary.xlsx"), parts["dictionary"])
        write_xlsx(at("metadata.xlsx"), parts["metadata"])
    if o["write_html"]:
        most = o["html_max_rows_per_table"]
        with open(at("metadata_report.html"), "w", encoding="utf-8") as f:
            f.write(_page("Data dictionary and metadata", [(name.replace("_", " "), html_table(t[name], most)) for _, name, *_ in CATALOG]))
        sections = [(d["dataset_label"] or d["dataset_name"], html_table(public_rows([r for r in t["data_dictionary"] if r["dataset_id"] == d["dataset_id"]]), most)) for d in t["dataset_metadata"]]
        with open(at("open_science_metadata_report.html"), "w", encoding="utf-8") as f:
            f.write(_page(f"Open science metadata report: {c['metadata']['project_name'] or 'Open science data release'}", [*public_overview(t, most), *sections]))
    found = sorted(os.path.join(d, f) for d, _, fs in os.walk(output) for f in fs)
    write_csv(at("artifact_manifest.csv"), [{"artifact": os.path.basename(p), "relative_path": os.path.relpath(p, output), "artifact_group": group_of(os.path.relpath(p, output)), "path": os.path.abspath(p), "size_bytes": os.path.getsize(p), "md5": files.md5_of(p)} for p in found])
