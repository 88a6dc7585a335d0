import csv
import gzip
import json
import zipfile

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldloom import registry
from fieldloom.config import DEFAULTS, load, merged
from fieldloom.operators.classify import classified
from fieldloom.operators.levels import categorical_levels
from fieldloom.operators.profile import Table, quartiles
from fieldloom.plans.run import CATALOG, dataset_ids, dictionary_of, profile, run, write_xlsx
from fieldloom.sources import files

SF = "/root/testdata/sf0.001"


def one(df, name):
    return df.filter(F.col("variable_name") == name).first()


def test_names_are_not_categories(spark):
    rows = [(f"Person {i}", "active" if i % 2 else "idle", i) for i in range(12)]
    v = classified(Table(spark.createDataFrame(rows, "person_name string, status string, score int"), "people")).cache()
    assert not one(v, "person_name").categorical_eligible and one(v, "person_name").semantic_type == "identifier"
    assert one(v, "status").semantic_type == "categorical" and one(v, "score").semantic_type == "discrete_numeric"


@pytest.mark.parametrize(("n", "listed"), [(10, True), (11, False)])
def test_limit_of_levels(spark, n, listed):
    df = spark.createDataFrame([(f"V{i:02}",) for i in range(n)], "v string")
    assert classified(Table(df)).first().categorical_eligible is listed


def test_blank_null_and_factors(spark):
    df = spark.createDataFrame([(None, None), ("", "A"), ("   ", None)], "t string, f string")
    df = df.select("t", F.col("f").alias("f", metadata={"levels": ["A", "B"], "ordered": False}))
    t = Table(df)
    v = classified(t)
    assert one(v, "t").semantic_type == "text_all_missing" and one(v, "t").cardinality_class == "all_missing"
    got = [(r.raw_value, r["count"]) for r in categorical_levels(t, v).orderBy("level_order").collect()]
    assert got == [("A", 1), ("B", 0), ("<MISSING>", 2)]


def test_blank_and_repeated_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "x", "")
    kinds = {r.issue_type for r in profile(df)["quality_issues"].collect()}
    assert {"duplicate_variable_name", "blank_variable_name"} <= kinds
    assert [r.variable for r in dictionary_of(df).orderBy("variable_position").collect()] == ["x", "x", "<unnamed_3>"]


def test_empty_table(spark):
    p = profile(spark.createDataFrame([], "a string, b double"))
    assert p["data_dictionary"].count() == 2 and p["categorical_levels"].count() == 0


def test_labels_make_definitions(spark):
    df = spark.createDataFrame([(0,), (1,)], "consent int").select(F.col("consent").alias("consent", metadata={"label": "Consent given", "labels": {"0": "No", "1": "Yes"}, "labelled": True}))
    r = dictionary_of(df).first()
    assert r.value_label == "0 = No; 1 = Yes" and r.business_definition == "Consent given" and r.value_domain_status == "source-defined code-label mapping"


@pytest.mark.parametrize("name", ["basic_stats_customer_dirty", "classification_customer_dirty", "quality_issues_customer_dirty", "data_dictionary_customer", "categorical_levels_dirty", "numeric_summary_orders"])
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in registry.TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, r = registry.queries()[name](spark, SF), c.sql(registry.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(r.columns)
    text = lambda x: "null" if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x)
    theirs = sorted(tuple(text(row[r.columns.index(n)]) for n in names) for row in r.fetchall())
    assert sorted(tuple(text(row[n]) for n in names) for row in df.collect()) == theirs


def test_config():
    assert merged(DEFAULTS, {"profiling": {"sample_values": 3}})["profiling"]["max_categorical_levels"] == 10
    with pytest.raises(ValueError, match="preview"):
        load({"dictionary": {"preview_values": 11}})
    with pytest.raises(ValueError, match="one character"):
        load({"input": {"text_delimiter": "||"}})


def test_formats():
    got = [files.detect_format(n) for n in ("study.csv.gz", "study.dta.xz", "study.sav.bz2", "study.xlsx.gz", "formats.sas7bcat")]
    assert got == ["csv", "dta", "sav", None, None] and files.is_auxiliary("formats.sas7bcat") and files.stem("/a/study.csv.gz") == "study"
    assert len(files.FORMATS) == 21 and len(CATALOG) == 19


def test_readers(spark, tmp_path):
    c = load()
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("id,group\n1,A\n2,NA\n3,B\n")
    (tmp_path / "b.jsonl").write_text('{"id":1,"x":{"y":2}}\n{"id":2,"x":{"y":3}}\n')
    (tmp_path / "c.json").write_text(json.dumps({"first": [{"a": 1}], "second": [{"b": "x"}, {"b": "y"}]}))
    write_xlsx(str(tmp_path / "d.xlsx"), {"baseline": [{"id": 1, "s": "x"}, {"id": 2, "s": None}], "later": [{"id": 1, "score": 1.5}]})
    table = pa.table({"id": [1, 2], "k": pa.array(["u", "v"]).dictionary_encode()})
    with pa.ipc.new_stream(str(tmp_path / "e.ipc"), table.schema) as w:
        w.write_table(table)
    got = {n: files.read_source(spark, str(tmp_path / n), c) for n in ("a.csv.gz", "b.jsonl", "c.json", "d.xlsx", "e.ipc")}
    assert [r.group for r in got["a.csv.gz"][0].df.collect()] == ["A", None, "B"]
    assert got["b.jsonl"][0].df.columns == ["id", "x.y"] and [d.object for d in got["c.json"]] == ["first", "second"]
    assert [d.name for d in got["d.xlsx"]] == ["d__baseline", "d__later"] and got["d.xlsx"][1].df.first().score == 1.5
    assert got["e.ipc"][0].df.schema["k"].metadata["levels"] == ["u", "v"]
    with pytest.raises(PermissionError):
        files.read_source(spark, str(tmp_path / "x.pkl"), c)
    dataset_ids(got["d.xlsx"])
    assert got["d.xlsx"][0].dataset_id == "d_baseline"


def test_end_to_end(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "e2e.csv").write_text("name,group,amount\n" + "".join(f"Person {i},{'AB'[i % 2]},{i * 10.5}\n" for i in range(1, 12)))
    (src / "x.por").write_bytes(b"")
    t = run(spark, [str(src)], str(tmp_path / "out"))
    s = t["summary"][0]
    assert (s["datasets"], s["variables"], s["dictionary_rows"], s["files_failed"]) == (1, 3, 3, 1)
    public = (tmp_path / "out/open_science_metadata_report.html").read_text()
    assert "definition gap(s)" in public and "<td>e2e</td><td>11</td><td>3</td>" in public
    assert str(src) not in public and "Person 1" not in public and ">NA<" not in public
    assert zipfile.ZipFile(tmp_path / "out/metadata.xlsx").testzip() is None and (tmp_path / "out/artifact_manifest.csv").exists()
    with pytest.raises(FileExistsError):
        run(spark, [str(src)], str(tmp_path / "out"))


def test_quartiles_of_extreme_values(spark):
    import math
    import random

    rng = random.Random(1)
    odd = [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.0**-1022, float("nan"), float("inf"), None]
    rows = [(rng.choice([rng.gauss(0, 1), rng.choice(odd), math.ldexp(rng.random(), rng.randint(-1000, 1000))]), rng.randint(-9, 9), None) for _ in range(500)]
    for n in (500, 499, 2, 1, 0):
        df = spark.createDataFrame(rows[:n], "a double, b long, c double")
        got = {r[0]: r[1:] for r in map(tuple, quartiles(Table(df)).collect())}
        for i in range(3):
            known = sorted(float(r[i]) for r in rows[:n] if r[i] is not None and math.isfinite(r[i]))
            assert (i + 1 in got) == bool(known)
            for share, x in zip((0.25, 0.5, 0.75), got.get(i + 1, ()), strict=False):
                at = (len(known) - 1) * share
                low, high = known[math.floor(at)], known[math.ceil(at)]
                assert x == (low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high)


def test_all_parsing_problems_are_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("fieldloom.plans.run.SHEET_ROWS", 1000)
    (tmp_path / "bad.csv").write_text("a,b\n" + "".join(f"{i},x\n" if i % 2 else f"{i},x,more\n" for i in range(5000)))
    (tmp_path / "good.csv").write_text("a,b\n1,x\n")
    t = run(spark, [str(tmp_path / "bad.csv"), str(tmp_path / "good.csv")], str(tmp_path / "out"))
    assert t["summary"][0]["import_problems"] == 2500 and [d["import_problem_count"] for d in t["dataset_metadata"]] == [2500, 0]
    issue = next(r for r in t["quality_issues"] if r["issue_type"] == "import_parsing_problems")
    assert issue["metric"] == 2500 and issue["message"].startswith("2500 ")
    wanted = [f"{i},x,more" for i in range(0, 5000, 2)]
    assert [r["actual"] for r in t["import_problems"]] == wanted and t["import_problems"][-1]["actual"] == "4998,x,more"
    with open(tmp_path / "out/csv/import_problems.csv", newline="") as f:
        assert [r["actual"] for r in csv.DictReader(f)] == wanted
    assert [r["actual"] for r in json.loads((tmp_path / "out/metadata.json").read_text())["import_problems"]] == wanted
    sheets = files.workbook(str(tmp_path / "out/metadata.xlsx"))
    assert [r[rows[0].index("actual")] for n, rows in sheets.items() if n.startswith("import_problems") for r in rows[1:]] == wanted


def test_numbers_read_alike_are_one_value(spark):
    from fieldloom.functions.columns import code_text
    from fieldloom.operators.profile import frequencies

    xs = [0.0, -0.0, 5.0, 0.1 + 0.2, 0.3, 1e15, 1e300, 1e-7, -2.5, float("inf"), 123456789.123456, None, float("nan")]
    got = {r.value: r.n for r in frequencies(Table(spark.createDataFrame([(x,) for x in xs], "x double"))).collect()}
    assert got == {"0": 2, "5": 1, "0.3": 2, "1.0E15": 1, "1.0E300": 1, "1.0E-7": 1, "-2.5": 1, "Infinity": 1, "123456789.123456": 1}
    assert [code_text(c) for c in (1, 1.0, "1.0", "1", -0.0, "2.50", "x", "1e3", "nan", 0.1 + 0.2)] == ["1", "1", "1", "1", "0", "2.5", "x", "1000", "nan", "0.3"]


def test_labels_of_doubles(spark):
    rows = [(f"Person {i}", "active" if i % 2 else "idle", float(i % 2)) for i in range(11)] + [("Person 11", "idle", None)]
    df = spark.createDataFrame(rows, "person_name string, status string, consent double")
    df = df.select(F.col("person_name").alias("person_name", metadata={"label": "Name"}), F.col("status").alias("status", metadata={"label": "Status"}), F.col("consent").alias("consent", metadata={"label": "Consent", "labels": {"0": "No", "1.0": "Yes"}, "labelled": True}))
    p = profile(df)
    r = one(p["data_dictionary"].withColumnRenamed("variable", "variable_name"), "consent")
    assert r.value_label == "0 = No; 1 = Yes" and r.value_representation == "code = label mapping" and r.value_domain_status == "source-defined code-label mapping"
    got = {r.raw_value: (r.value_label, r.display_value, r["count"]) for r in p["categorical_levels"].filter("variable_name = 'consent'").collect()}
    assert got == {"0": ("No", "0 \u2014 No", 6), "1": ("Yes", "1 \u2014 Yes", 5), "<MISSING>": (None, "<MISSING>", 1)}


def test_stata_labels_and_tags(spark, tmp_path):
    import pandas as pd

    path = str(tmp_path / "a.dta")
    frame = pd.DataFrame({"consent": [0.0, 1.0, None, 1.0], "status": ["a", "b", "a", "b"]})
    frame.to_stata(path, write_index=False, variable_labels={"consent": "Consent given"}, value_labels={"consent": {0: "No", 1: "Yes"}})
    (d,) = files.read_source(spark, path, load())
    p = profile(d.df)
    got = {r.raw_value: (r.value_label, r["count"]) for r in p["categorical_levels"].filter("variable_name = 'consent'").collect()}
    assert got == {"0": ("No", 1), "1": ("Yes", 2), "<MISSING>": (None, 1)}
    assert p["data_dictionary"].filter("variable = 'consent'").first().label == "Consent given"
    data = bytearray(open(path, "rb").read())
    assert files.trailing_payload(bytes(data)) is None


def test_stata_recovery_and_trailing_bytes(spark, tmp_path):
    import pandas as pd

    path = str(tmp_path / "b.dta")
    pd.DataFrame({"id": [1, 2, 3], "status": ["x", "y", "z"], "amount": [1.5, None, 2.5]}).to_stata(path, write_index=False, version=114)
    data = open(path, "rb").read()
    whole = files._stata_layout(data)[-1]
    with open(path, "wb") as f:
        f.write(data[:whole] + bytes([0, 0, 0, 0, 1, 2, 3, 4]))
    (d,) = files.read_source(spark, path, load())
    assert "recovery" in d.notes and [tuple(r) for r in d.df.collect()] == [(1, "x", 1.5), (2, "y", None), (3, "z", 2.5)]


def test_values_declared_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (97.0,), (99.0,), (None,)], "x double").select(F.col("x").alias("x", metadata={"na_values": [9.0], "na_range": [97.0, 99.0], "tags": {"b": 1, "a": 1}}))
    r = profile(df)["variable_metadata"].first()
    assert (r.n_system_missing, r.n_non_missing, r.numeric_max, r.numeric_median) == (4, 2, 2.0, 1.5)
    assert (r.user_missing_values, r.user_missing_range, r.tagged_missing_summary) == ("9", "97 to 99", "a=1; b=1")


def test_types_that_cannot_be_grouped(spark):
    df = spark.sql("SELECT parse_json('{\"a\": 1}') AS v, map('k', 1) AS m, array(map('k', id)) AS am, id FROM range(3) UNION ALL SELECT parse_json('{\"a\": 1}'), map('k', 1), array(map('k', 0L)), 0")
    p = profile(df)
    facts = p["dataset_metadata"].first()
    assert (facts.n_rows, facts.duplicate_rows, facts.duplicate_check_performed) == (4, 1, True)
    assert [r.semantic_type for r in p["data_dictionary"].orderBy("variable_position").collect()] == ["nested_or_list"] * 3 + ["discrete_numeric"]


def test_rows_repeat_by_nulls_in_place(spark):
    from fieldloom.operators.profile import duplicate_rows

    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), (None, None, float("nan")), (None, None, float("nan")), ("ab", "c", 1.0), ("a", "bc", 1.0)]
    assert tuple(duplicate_rows(spark.createDataFrame(rows, "a string, b string, c double")).first()) == (7, 2)


@pytest.mark.parametrize(("n", "checked"), [(90909, True), (90910, False)])
def test_metadata_count_duplicates_beyond_the_limit(spark, tmp_path, n, checked):
    c = duckdb.connect()
    c.sql(f"COPY (SELECT i AS c_custkey, 'Customer#' || i AS c_name, (i % 25)::INT AS c_nationkey, i / 7.0::DOUBLE AS c_acctbal, 'MACHINERY' AS c_mktsegment FROM range({n}) AS r(i)) TO '{tmp_path}/customer.parquet' (FORMAT parquet)")
    c.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    df, r = registry.queries()["dataset_metadata_dirty"](spark, str(tmp_path)), c.sql(registry.oracle_sql()["dataset_metadata_dirty"])
    assert df.columns == r.columns and [tuple(x) for x in df.collect()] == r.fetchall()
    assert df.select("n_rows", "duplicate_rows", "duplicate_check_performed").first() == (n + 9091, 9091, checked)


def test_no_columns(spark, tmp_path):
    p = profile(spark.createDataFrame([], "a int").drop("a"))
    assert p["variable_metadata"].count() == 0 and p["data_dictionary"].count() == 0 and p["dataset_metadata"].first().n_columns == 0
    (tmp_path / "none.csv").write_bytes(b"")
    t = run(spark, [str(tmp_path / "none.csv")], str(tmp_path / "out"))
    assert t["summary"][0]["datasets"] == 1 and t["summary"][0]["errors"] == 0
    from fieldloom.operators.tables import columns_of

    for _, name, *_ in CATALOG:
        with open(tmp_path / f"out/csv/{name}.csv", newline="") as f:
            assert next(csv.reader(f)) == columns_of(name), name
    with open(tmp_path / "out/artifact_manifest.csv", newline="") as f:
        groups = {r["artifact"]: r["artifact_group"] for r in csv.DictReader(f)}
    assert groups["value_labels.csv"] == "dictionary + metadata" and groups["resolved_config.yml"] == "control" and groups["open_science_metadata_report.html"] == "public report" and groups["errors.csv"] == "metadata"


def delimited(spark, tmp_path, text, name="a.csv"):
    (tmp_path / name).write_bytes(text.encode())
    (d,) = files.read_source(spark, str(tmp_path / name), load())
    return d


def test_quoted_newlines(spark, tmp_path):
    d = delimited(spark, tmp_path, 'id,text\n1,"a\nb"\n2,plain\n3,"x ""y"", z"\n4,"\n"\n')
    assert [tuple(r) for r in d.df.collect()] == [(1, "a\nb"), (2, "plain"), (3, 'x "y", z'), (4, "\n")] and d.problems is None


def test_ragged_lines_are_problems(spark, tmp_path):
    d = delimited(spark, tmp_path, "id,group\n1,A\n2,B,extra\n3\n4,\"C,c\"\n5,\"D,d\",e,f\n")
    assert d.df.count() == 5 and d.problems.count() == 3
    assert [(r.row, r.col, r.expected, r.actual, r.problem_file) for r in d.problems.orderBy("row").collect()] == [(3, 3, "2 columns", "2,B,extra", d.source_file), (4, 1, "2 columns", "3", d.source_file), (6, 4, "2 columns", '5,"D,d",e,f', d.source_file)]
    t = run(spark, [d.source_file])
    assert [(r["issue_type"], r["metric"]) for r in t["quality_issues"] if r["issue_type"] == "import_parsing_problems"] == [("import_parsing_problems", 3.0)]
    # The same where a record goes on over a line's end.
    d = delimited(spark, tmp_path, 'id,group\n1,"A\na"\n2,B,extra\n3\n', "b.csv")
    assert [(r.row, r.col) for r in d.problems.orderBy("row").collect()] == [(3, 3), (4, 1)] and d.df.count() == 3


def test_problems_are_numbered_over_parts_of_a_file(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        d = delimited(spark, tmp_path, "a,b\n" + "".join(f"{i},x\n" if i % 97 else f"{i}\n" for i in range(3000)))
        assert d.df.rdd.getNumPartitions() > 2
        assert sorted((r.row, r.actual) for r in d.problems.collect()) == [(i + 2, str(i)) for i in range(0, 3000, 97)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headers_as_they_stand(spark, tmp_path):
    d = delimited(spark, tmp_path, "id,id,,x y\n1,2,3,NA\n4,5,,z\n")
    assert d.df.columns == ["id", "id", "", "x y"]
    assert [r.variable for r in profile(d.df)["data_dictionary"].orderBy("variable_position").collect()] == ["id", "id", "<unnamed_3>", "x y"]
    t = run(spark, [d.source_file])
    assert {"duplicate_variable_name", "blank_variable_name"} <= {r["issue_type"] for r in t["quality_issues"]}
    assert [tuple(r) for r in d.df.collect()] == [(1, 2, 3, None), (4, 5, None, "z")]


def test_delimiters_and_xz(spark, tmp_path):
    import lzma

    (tmp_path / "a.tsv.xz").write_bytes(lzma.compress(b"id\tgroup\n1\tA\n2\tB\n3\tC\n"))
    (tmp_path / "b.txt").write_text("id|group\n1|A\n2|B\n3|C\n")
    c = load({"input": {"text_delimiter": "|"}})
    for name in ("a.tsv.xz", "b.txt"):
        (d,) = files.read_source(spark, str(tmp_path / name), c)
        assert d.df.columns == ["id", "group"] and [tuple(r) for r in d.df.collect()] == [(1, "A"), (2, "B"), (3, "C")]


def test_long_texts_are_told_apart(spark):
    from fieldloom.operators.profile import frequencies, pattern_ratios

    mail = "a" * 2000 + "@example.org"
    df = spark.createDataFrame([("x" * 5000 + "a",), ("x" * 5000 + "b",), ("x" * 5000 + "b",), (mail,)], "t string")
    assert sorted(r.n for r in frequencies(Table(df)).collect()) == [1, 1, 2]
    assert max(len(r.value) for r in frequencies(Table(df), whole=True).collect()) == 5001
    assert abs(pattern_ratios(Table(df)).first().email_ratio - 1 / 3) < 1e-9


def test_a_cluster_needs_a_shared_folder():
    from fieldloom.functions.shared import shared_dir

    class Session:
        class conf:
            get = staticmethod(lambda k, d=None: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(Session)


def test_dates_of_workbooks(spark, tmp_path):
    path = str(tmp_path / "d.xlsx")
    write_xlsx(path, {"s": [{"id": 1, "day": 45292, "at": 45292.5}, {"id": 2, "day": 45293, "at": None}]})
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    styles = parts["xl/styles.xml"].replace(b'<cellXfs count="3">', b'<cellXfs count="5">').replace(b"</cellXfs>", b'<xf numFmtId="14"/><xf numFmtId="170"/></cellXfs>').replace(b"<fonts", b'<numFmts count="1"><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd hh:mm"/></numFmts><fonts')
    sheet = parts["xl/worksheets/sheet1.xml"].replace(b'r="B2" s="0"', b'r="B2" s="3"').replace(b'r="B3" s="0"', b'r="B3" s="3"').replace(b'r="C2" s="0"', b'r="C2" s="4"')
    with zipfile.ZipFile(path, "w") as z:
        for n, b in (parts | {"xl/styles.xml": styles, "xl/worksheets/sheet1.xml": sheet}).items():
            z.writestr(n, b)
    (d,) = files.read_source(spark, path, load())
    assert [tuple(map(str, r)) for r in d.df.collect()] == [("1", "2024-01-01 00:00:00", "2024-01-01 12:00:00"), ("2", "2024-01-02 00:00:00", "None")]


def test_reader_in_its_own_process(spark, tmp_path):
    from fieldloom.sources.worker import isolated

    with pytest.raises(RuntimeError, match="reader of dta files ended with 1"):
        isolated("dta", b"not a file", None)
    (tmp_path / "x.dta").write_bytes(b"not a file")
    t = run(spark, [str(tmp_path / "x.dta")])
    assert t["input_inventory"][0]["status"] == "failed" and t["errors"][0]["stage"] == "ingestion"
