import gzip
import struct
import zlib

import pytest

from fieldloom.config import load
from fieldloom.plans.run import profile
from fieldloom.sources import files, foreign


def padded(x, n):
    return x.ljust(n, b" ")[:n]


def system_file(compression):
    """Three cases of id, status (10 bytes), consent (labelled, 9 declared missing) and a date."""
    out = (b"$FL3" if compression == 2 else b"$FL2") + padded(b"@(#) test", 60) + struct.pack("<iiiiid", 2, 5, compression, 0, 3, 100.0) + padded(b"01 Jan 24", 9) + padded(b"00:00:00", 8) + padded(b"A study", 64) + b"\0\0\0"

    def variable(name, width, fmt, label=None, missing=()):
        x = struct.pack("<iiiiii", 2, width, bool(label), len(missing), fmt, fmt) + padded(name, 8)
        if label:
            x += struct.pack("<i", len(label)) + label.ljust(-(-len(label) // 4) * 4)
        return x + b"".join(struct.pack("<d", m) for m in missing)

    number, text, date = 5 << 16 | 8 << 8 | 2, 1 << 16 | 10 << 8, 23 << 16 | 10 << 8
    out += variable(b"ID", 0, number, b"Identifier") + variable(b"STATUS", 10, text) + variable(b"", -1, 0) + variable(b"CONSENT", 0, number, b"Consent given", (9.0,)) + variable(b"DAY", 0, date)
    out += struct.pack("<ii", 3, 2) + b"".join(struct.pack("<d", v) + bytes([len(t)]) + t.ljust((len(t) + 8) // 8 * 8 - 1) for v, t in ((0.0, b"No"), (1.0, b"Yes")))
    out += struct.pack("<iii", 4, 1, 4)
    names = b"ID=id\tSTATUS=status\tCONSENT=consent_long_name\tDAY=day"
    out += struct.pack("<iiii", 7, 13, 1, len(names)) + names + struct.pack("<iiii", 7, 20, 1, 5) + b"UTF-8" + struct.pack("<ii", 999, 0)
    day = 12_219_379_200.0 + 86400 * 19_000
    sysmis = struct.unpack("<d", b"\xff\xff\xff\xff\xff\xff\xef\xff")[0]
    cases = [(1.0, b"active", 1.0, day), (2.0, "\u00e9tat".encode(), 9.0, sysmis), (3.5, b"", 0.0, day)]
    if compression == 0:
        return out + b"".join(struct.pack("<d", a) + padded(s, 16) + struct.pack("<dd", c, d) for a, s, c, d in cases)
    codes, data = [], b""
    body = b""

    def put(code, raw=b""):
        nonlocal codes, data, body
        codes.append(code)
        data += raw
        if len(codes) == 8:
            body += bytes(codes) + data
            codes, data = [], b""

    for a, s, c, d in cases:
        for v in (a, padded(s, 16)[:8], padded(s, 16)[8:], c, d):
            if isinstance(v, bytes):
                put(254) if v == b" " * 8 else put(253, v)
            elif v == sysmis:
                put(255)
            elif v == int(v) and -99 <= v <= 151:
                put(int(v) + 100)
            else:
                put(253, struct.pack("<d", v))
    put(252)
    while codes:
        put(0)
    if compression == 1:
        return out + body
    at = len(out)
    packed = [zlib.compress(body[:40]), zlib.compress(body[40:])]
    ends = at + 24 + sum(map(len, packed))
    header = struct.pack("<qqq", at, ends, 24 + 24 * 2)
    trailer = struct.pack("<qqii", -100, 0, 40, 2) + struct.pack("<qqii", at, at + 24, 40, len(packed[0])) + struct.pack("<qqii", at + 40, at + 24 + len(packed[0]), len(body) - 40, len(packed[1]))
    return out + header + b"".join(packed) + trailer


@pytest.mark.parametrize(("compression", "name"), [(0, "a.sav"), (1, "b.sav"), (2, "c.zsav"), (1, "d.sav.gz")])
def test_spss(spark, tmp_path, compression, name):
    data = system_file(compression)
    (tmp_path / name).write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    (d,) = files.read_source(spark, str(tmp_path / name), load())
    assert d.df.columns == ["id", "status", "consent_long_name", "day"] and d.label == "A study"
    rows = [tuple(map(str, r)) for r in d.df.collect()]
    assert rows == [("1.0", "active", "1.0", "2022-01-08"), ("2.0", "\u00e9tat", "9.0", "None"), ("3.5", "", "0.0", "2022-01-08")]
    p = profile(d.df)
    v = p["variable_metadata"].filter("variable_name = 'consent_long_name'").first()
    assert (v.variable_label, v.user_missing_values, v.n_system_missing, v.source_display_format, v.semantic_type) == ("Consent given", "9", 1, "F8.2", "labelled_categorical")
    got = {r.raw_value: r.value_label for r in p["categorical_levels"].filter("variable_name = 'consent_long_name'").collect()}
    assert got == {"0": "No", "1": "Yes", "<MISSING>": None}
    assert files.read_source(spark, str(tmp_path / name), load({"input": {"n_max": 2}}))[0].df.count() == 2
    with pytest.raises(ValueError):
        foreign.read_spss(data[:180])


class Writer:
    """R's binary format, as far as the tests need it."""

    def __init__(self):
        self.symbols = {}

    def chars(self, x):
        return struct.pack(">ii", 9, -1) if x is None else struct.pack(">ii", 9 | 8 << 12, len(x.encode())) + x.encode()

    def symbol(self, name):
        if name in self.symbols:
            return struct.pack(">i", self.symbols[name] << 8 | 255)
        self.symbols[name] = len(self.symbols) + 1
        return struct.pack(">i", 1) + self.chars(name)

    def pairs(self, members):
        return b"".join(struct.pack(">i", 2 | 1024) + self.symbol(k) + v() for k, v in members) + struct.pack(">i", 254)

    def vector(self, kind, values, **attributes):
        flags = {"lgl": 10, "int": 13, "dbl": 14, "chr": 16, "list": 19}[kind] | (512 | 256 if attributes else 0)
        out = struct.pack(">ii", flags, len(values))
        if kind == "chr":
            out += b"".join(map(self.chars, values))
        elif kind == "list":
            out += b"".join(v() for v in values)
        else:
            out += b"".join(struct.pack(">d", float("nan") if v is None else v) if kind == "dbl" else struct.pack(">i", -(1 << 31) if v is None else v) for v in values)
        return out + (self.pairs([(k, v) for k, v in attributes.items()]) if attributes else b"")

    def frame(self, columns, rows):
        names = lambda: self.vector("chr", list(columns))
        return self.vector("list", list(columns.values()), names=names, **{"class": lambda: self.vector("chr", ["data.frame"]), "row.names": lambda: self.vector("int", [None, -rows])})


def r_frame(w):
    chars = lambda *x: lambda: w.vector("chr", list(x))
    return w.frame({
        "id": lambda: w.vector("int", [1, 2, None]),
        "status": lambda: w.vector("int", [2, 1, None], levels=chars("idle", "active"), **{"class": chars("factor")}),
        "consent": lambda: w.vector("dbl", [1.0, 0.0, None], label=chars("Consent given"), labels=lambda: w.vector("dbl", [0.0, 1.0], names=chars("No", "Yes")), **{"class": chars("haven_labelled", "vctrs_vctr", "double")}),
        "day": lambda: w.vector("dbl", [19_000.0, None, 0.0], **{"class": chars("Date")}),
        "flag": lambda: w.vector("lgl", [1, 0, None]),
        "name": chars("x", None, "\u00e9"),
    }, 3)


def check_frame(df):
    assert df.columns == ["id", "status", "consent", "day", "flag", "name"]
    assert [tuple(map(str, r)) for r in df.collect()] == [("1", "active", "1.0", "2022-01-08", "True", "x"), ("2", "idle", "0.0", "None", "False", "None"), ("None", "None", "None", "1970-01-01", "None", "\u00e9")]
    p = profile(df)
    kinds = {r.variable: r.semantic_type for r in p["data_dictionary"].collect()}
    assert kinds == {"id": "discrete_numeric", "status": "categorical", "consent": "labelled_categorical", "day": "date", "flag": "binary_categorical", "name": "categorical"}
    assert [r.raw_value for r in p["categorical_levels"].filter("variable_name = 'status'").orderBy("level_order").collect()] == ["idle", "active", "<MISSING>"]


@pytest.mark.parametrize("version", [2, 3])
def test_rds(spark, tmp_path, version):
    w = Writer()
    head = b"X\n" + struct.pack(">iii", version, 0x40000, 0x20300) + (struct.pack(">i", 5) + b"UTF-8" if version == 3 else b"")
    (tmp_path / "a.rds").write_bytes(gzip.compress(head + r_frame(w)))
    (d,) = files.read_source(spark, str(tmp_path / "a.rds"), load())
    assert d.name == "a" and d.object is None
    check_frame(d.df)


def test_rdata(spark, tmp_path):
    w = Writer()
    head = b"RDX2\nX\n" + struct.pack(">iii", 2, 0x40000, 0x20300)
    second = lambda: w.frame({"code": lambda: w.vector("chr", ["A", "B", "C"])}, 3)
    body = w.pairs([("first", lambda: r_frame(w)), ("second", second), ("scalar", lambda: w.vector("dbl", [1.0]))])
    (tmp_path / "b.RData").write_bytes(head + body)
    got = files.read_source(spark, str(tmp_path / "b.RData"), load())
    assert [(d.name, d.object) for d in got] == [("b__first", "first"), ("b__second", "second")] and got[1].df.count() == 3
    check_frame(got[0].df)
    assert [d.object for d in files.read_source(spark, str(tmp_path / "b.RData"), load({"input": {"r_objects": ["second"]}}))] == ["second"]
    with pytest.raises(ValueError, match="unknown"):
        files.read_source(spark, str(tmp_path / "b.RData"), load({"input": {"r_objects": ["none"]}}))


def test_short_vectors_of_r():
    w = Writer()
    state = w.vector("dbl", [3.0, 5.0, 2.0])
    info = struct.pack(">i", 2) + w.symbol("compact_intseq") + struct.pack(">i", 254)
    head = b"X\n" + struct.pack(">iii", 2, 0, 0)
    # The class's name stands as the first member of a pair list.
    data = head + struct.pack(">i", 238) + info + state + struct.pack(">i", 254)
    assert foreign._Serialized(data).item().value == [5, 7, 9]
