import csv
import json
import os

import pytest

from fieldloom.__main__ import main, overrides, parser
from fieldloom.operators.dictionary import ORDER
from fieldloom.operators.schema import DEFINITIONS, schema_rows
from fieldloom.plans.project import REQUIRED, Version, launch, read_profile, write_profile


def job(output, saved):
    os.makedirs(output)
    for name in REQUIRED:
        with open(os.path.join(output, name), "w") as f:
            f.write("x")


def test_schema_covers_the_dictionary():
    assert [r["column_name"] for r in schema_rows()] == list(ORDER) and set(DEFINITIONS) == set(ORDER)


def test_versions(tmp_path):
    first = Version("My Project", str(tmp_path))
    assert launch(first, job) and os.path.realpath(os.path.join(first.folder, "current")) == os.path.realpath(first.path)
    second = Version("My Project", str(tmp_path))
    assert second.path != first.path and not launch(second, job)
    third = Version("My Project", str(tmp_path), "replace", 'a, "b"')
    assert launch(third, job) and os.path.realpath(os.path.join(first.folder, "current")) == os.path.realpath(third.path)
    with open(os.path.join(first.folder, "run_history.csv")) as f:
        rows = list(csv.DictReader(f))
    assert [r["became_current"] for r in rows] == ["true", "false", "true"] and rows[2]["comment"] == 'a, "b"'
    with pytest.raises(FileNotFoundError):
        launch(Version("My Project", str(tmp_path)), lambda output, saved: None)


def test_profile(tmp_path):
    path = str(tmp_path / "p" / "project_metadata.yml")
    write_profile(path, "A", {"author": "NA", "license": "MIT", "tags": "x, y, x, NA"})
    write_profile(path, "B", {"author": "me", "license": "MIT", "tags": "x, y"})
    assert read_profile(path)["tags"] == "x, y" and json.loads(read_profile(path, True))["author"] == "me"
    assert os.path.exists(path.replace(".yml", ".previous.yml"))


def test_settings(capsys):
    got = overrides(parser().parse_args(["run", "--input", "a", "--recursive", "--n-max", "5", "--overwrite", "false", "--tags", "a,b", "--tags", "c", "--excel-sheets", "all"]))
    assert got == {"input": {"recursive": True, "n_max": 5, "excel_sheets": "all"}, "output": {"overwrite": False}, "metadata": {"tags": ["a", "b", "c"]}}
    assert main(["list"]) == 0 and "data_dictionary" in capsys.readouterr().out


def seen(spark, inputs, output, config, settings):
    return inputs


def test_pipelines(tmp_path, capsys):
    from fieldloom.plans import pipelines

    path = tmp_path / "pipelines.yml"
    path.write_text("pipelines:\n  own:\n    entry: tests.test_project:seen\n    description: what is seen\n  closed:\n    entry: a:b\n    enabled: false\n  gone:\n    entry: no.such.module:run\n")
    assert list(pipelines.known(str(path))) == ["closed", "data_dictionary", "gone", "own"]
    assert pipelines.resolved("data_dictionary").load().__name__ == "run"
    for name in ("closed", "none"):
        with pytest.raises(LookupError):
            pipelines.resolved(name, str(path))
    with pytest.raises(LookupError, match="can't be loaded"):
        pipelines.resolved("gone", str(path)).load()
    assert main(["list", "--registry", str(path)]) == 0 and "own: what is seen" in capsys.readouterr().out
    (tmp_path / "bad.yml").write_text("pipelines: {x: {}}")
    with pytest.raises(ValueError):
        pipelines.known(str(tmp_path / "bad.yml"))
    pipelines.register(pipelines.Pipeline("mine", "fieldloom.plans.run:run"))
    assert "mine" in pipelines.known()
    del pipelines._KNOWN["mine"]
