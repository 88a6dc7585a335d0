"""Profiling: one wide aggregate for counts and moments, one frequency table for everything that needs distinct values.

The frequency table has a row for each distinct value of each column (column position, value, count, first row), built
by one exploded aggregation with map-side combination; distinct counts, levels, examples and samples come from it.
Values are grouped as numbers, times or texts, and long texts by their beginning and a digest; only distinct ones are
turned into canonical text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import FLOATS, INTEGERS, blank, canonical, comparable, digits15, missing, quoted, trimmed

NUMERIC = (*FLOATS, *INTEGERS, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
DURATIONS = (T.DayTimeIntervalType, T.YearMonthIntervalType)
#: Shapes of texts. Characters of a text that the frequency table keeps whole.
SHAPES = {"email": r"^[^\s@]+@[^\s@]+\.[^\s@]+$", "phone": r"^\+?[0-9][0-9 ()-]{6,}$", "uuid": r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"}
LONG = 1000


class Table:
    """A DataFrame whose columns are known by position, so that blank and repeated names are legal; labels, value labels and levels come from the fields' metadata."""

    def __init__(self, df: DataFrame, name: str = "data", config: dict | None = None, source_format: str = "in_memory", label: str | None = None):
        from ..config import load

        self.name, self.config, self.source_format, self.label = name, config or load(), source_format, label
        self.fields = df.schema.fields
        self.df = df.toDF(*[f"c{i}" for i in range(len(self.fields))])

    def columns(self) -> list[tuple[int, str, T.StructField]]:
        """Position, name in SQL, field."""
        return [(i + 1, f"c{i}", f) for i, f in enumerate(self.fields)]

    def display(self, i: int) -> str:
        return self.fields[i - 1].name or f"<unnamed_{i}>"

    def absent(self, c: str, f: T.StructField) -> str:
        """Null, NaN, or one of the values that the source declares missing (na_values, na_range of the field's metadata)."""
        m, literal = f.metadata or {}, lambda v: quoted(v) if isinstance(v, str) else repr(v)
        out = [missing(c, f.dataType), *[f"coalesce({c} = {literal(v)}, FALSE)" for v in m.get("na_values") or []]]
        if m.get("na_range"):
            out.append(f"coalesce({c} BETWEEN {literal(m['na_range'][0])} AND {literal(m['na_range'][1])}, FALSE)")
        return f"({' OR '.join(out)})" if len(out) > 1 else out[0]

    def gone(self, c: str, f: T.StructField) -> str:
        """Effectively missing."""
        listed = isinstance(f.dataType, T.StringType) and self.config["profiling"]["blank_as_missing"]
        return f"({self.absent(c, f)} OR {blank(c, f.dataType)})" if listed else self.absent(c, f)

    def known(self, c: str, f: T.StructField) -> str:
        """The column without values that are declared missing."""
        return f"CASE WHEN NOT {self.absent(c, f)} THEN {c} END" if {"na_values", "na_range"} & set(f.metadata or {}) else c


def finite(c: str, kind: T.DataType) -> str:
    """As a double; null unless finite."""
    x = f"cast({c} AS double)"
    return f"CASE WHEN NOT isnan({x}) AND abs({x}) != double('Infinity') THEN {x} END" if isinstance(kind, FLOATS) else x


def ordered_code(x: Column) -> Column:
    """A long that doesn't fall as x rises: the logarithm, which the JVM promises to be monotonic, with 36 bits after the point. At most some 100,000 doubles share one."""
    code = F.floor((F.log2(F.abs(x)) + 1100.0) * float(1 << 36))
    return F.when(x > 0, code).when(x < 0, -code).otherwise(F.lit(0).cast("long"))


def quartiles(table: Table, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """variable_position and q0, q1 ...: exact interpolated quantiles of numeric columns, by narrowing counts.

    Values are counted by the leading bits of their code; the bins that hold a wanted rank (two for each share and
    column, so they can be broadcast) are counted by more bits, then by value. Each round shuffles counts of bins,
    whose number the code's width bounds, and never the values.
    """
    cells = {i: finite(table.known(c, f), f.dataType) for i, c, f in table.columns() if isinstance(f.dataType, NUMERIC)}
    if not cells:
        return table.df.sparkSession.createDataFrame([], "variable_position int" + "".join(f", q{k} double" for k in range(len(shares))))
    place = F.expr(f"element_at(array({', '.join(map(str, cells))}), pos + 1)")
    values = table.df.select(F.posexplode(F.expr(f"array({', '.join(cells.values())})")).alias("pos", "x")).filter("x is not null").select(place.alias("variable_position"), "x", ordered_code(F.col("x")).alias("code"))
    at = lambda share: (F.col("total") - 1) * F.lit(share)
    here = lambda rank: (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))
    key, found = ["variable_position"], None
    for bits in (30, 10, None):
        part = F.shiftright("code", bits) if bits is not None else F.col("x")
        if found is None:
            counts = values.groupBy(*key, part.alias("part")).agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.lit(0).cast("long"))
            counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy(*key)))
        else:
            inside = values.withColumn("bin", F.shiftright("code", last)).join(F.broadcast(found), [*key, "bin"])
            counts = inside.groupBy(*key, "bin", "start", "total", part.alias("part")).agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("bin", "outer")
        group = [*key, "outer"] if found is not None else key
        running = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("before", F.col("start") + F.sum("n").over(running) - F.col("n"))
        holds = reduce(lambda a, b: a | b, [here(f(at(s))) for s in shares for f in (F.floor, F.ceil)])
        found, last = counts.filter(holds).select(*key, F.col("part").alias("bin"), F.col("before").alias("start"), "total", "n", "before"), bits
        if bits is not None:
            found = found.drop("n", "before")
    ends = [F.max(F.when(here(f(at(s))), F.col("bin"))).alias(f"{name}{k}") for k, s in enumerate(shares) for name, f in (("low", F.floor), ("high", F.ceil))]
    ends = found.groupBy(*key, "total").agg(*ends)
    mixed = lambda k, s: F.when(F.col(f"low{k}") == F.col(f"high{k}"), F.col(f"low{k}")).otherwise((F.ceil(at(s)) - at(s)) * F.col(f"low{k}") + (at(s) - F.floor(at(s))) * F.col(f"high{k}"))
    return ends.select(*key, *[mixed(k, s).alias(f"q{k}") for k, s in enumerate(shares)])


BASIC_SCHEMA = "variable_position long, variable_name string, source_variable_name string, storage_type string, n_rows long, n_system_missing long, n_missing long, n_blank_strings long, n_non_missing long, string_min_length double, string_mean_length double, string_max_length double, n_leading_trailing_whitespace long, numeric_min double, numeric_q1 double, numeric_median double, numeric_mean double, numeric_q3 double, numeric_max double, numeric_sd double, n_infinite long, date_min string, date_max string, timezone string"


def basic_stats(table: Table) -> DataFrame:
    """A row for each column: counts, numeric and date summaries, text lengths. One pass, one row shuffled per task; quartiles are null, with_quartiles() has them."""
    if not table.fields:
        return table.df.sparkSession.createDataFrame([], BASIC_SCHEMA)
    aggs, rows = ["count(1) AS rows"], []
    for i, c, f in table.columns():
        gone, kind = table.gone(c, f), f.dataType
        own = {"n_system_missing": f"count_if({table.absent(c, f)})", "n_missing": f"count_if({gone})"}
        if isinstance(kind, T.StringType):
            length = f"CASE WHEN NOT {gone} THEN length({c}) END"
            own |= {"n_blank_strings": f"count_if({blank(c, kind)})", "string_min_length": f"min({length})", "string_mean_length": f"avg({length})", "string_max_length": f"max({length})", "n_leading_trailing_whitespace": f"count_if({c} != {trimmed(c)})"}
        if isinstance(kind, NUMERIC):
            x = finite(table.known(c, f), kind)
            own |= {"numeric_min": f"min({x}) + 0D", "numeric_mean": f"avg({x})", "numeric_max": f"max({x}) + 0D", "numeric_sd": f"stddev_samp({x})"}
            if isinstance(kind, FLOATS):
                own["n_infinite"] = f"count_if(abs({c}) = double('Infinity'))"
        if isinstance(kind, TIMES):
            shape = "yyyy-MM-dd" if isinstance(kind, T.DateType) else "yyyy-MM-dd'T'HH:mm:ss'Z'"
            own |= {"date_min": f'date_format(min({c}), "{shape}")', "date_max": f'date_format(max({c}), "{shape}")'}
        aggs += [f"{v} AS {k}_{i}" for k, v in own.items()]
        known = {"variable_position": str(i), "variable_name": quoted(table.display(i)), "source_variable_name": quoted(f.name), "storage_type": quoted(kind.simpleString().split("<")[0]), "n_rows": "rows", "n_non_missing": f"rows - n_missing_{i}", "timezone": "'UTC'" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else "NULL"}
        zero = lambda k: "0" if k in ("n_blank_strings", "n_leading_trailing_whitespace", "n_infinite") else "NULL"
        members = ", ".join(f"cast({known.get(k) or (f'{k}_{i}' if k in own else zero(k))} AS {t}) AS {k}" for k, t in (m.split() for m in BASIC_SCHEMA.split(", ")))
        rows.append(f"struct({members})")
    return table.df.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))")


def with_quartiles(table: Table, stats: DataFrame) -> DataFrame:
    """stats with quartiles of the numeric columns, if there are any: three more scans of those columns."""
    if not any(isinstance(f.dataType, NUMERIC) for f in table.fields):
        return stats
    # A row for each column on both sides.
    names = {"numeric_q1": 0.25, "numeric_median": 0.5, "numeric_q3": 0.75} if table.config["profiling"]["include_quantiles"] else {"numeric_median": 0.5}
    ranked = quartiles(table, tuple(names.values())).withColumnRenamed("variable_position", "at")
    joined = stats.join(F.broadcast(ranked), F.col("variable_position") == F.col("at"), "left")
    return joined.withColumns({q: F.col(f"q{k}") for k, q in enumerate(names)}).select(*stats.columns)


def frequencies(table: Table, only: list[int] | None = None, whole: bool = False) -> DataFrame:
    """variable_position, value (canonical text), long, shape, n, first_row, of all columns or those at the given positions; effectively missing values are left out.

    Unless `whole`, texts beyond LONG characters come as their first ones, told apart by the digest `long`; `shape` has
    a bit for each of SHAPES that such a text has. Doubles are grouped at 15 significant digits.
    """
    # Cells by kind, in arrays: what is done to a cell is generated once and not for each column.
    cells: dict[str, list[tuple[int, str, str]]] = {"d": [], "l": [], "s": [], "t": []}
    for i, c, f in table.columns():
        if only is not None and i not in only:
            continue
        kind, own = f.dataType, table.known(c, f)
        if isinstance(kind, FLOATS):
            cells["d"].append((i, f"cast({own} AS double)", canonical("d", kind)))
        elif isinstance(kind, INTEGERS):
            cells["l"].append((i, f"cast({own} AS bigint)", "cast(l AS string)"))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            cells["l"].append((i, f"unix_seconds(cast({own} AS timestamp))", canonical("timestamp_seconds(l)", kind)))
        elif isinstance(kind, T.StringType):
            cells["s"].append((i, own, "t"))
        else:
            cells["t"].append((i, f"CASE WHEN NOT {table.absent(c, f)} THEN {canonical(c, kind)} END", "t"))
    every = [x for part in cells.values() for x in part]
    if not every:
        return table.df.sparkSession.createDataFrame([], "variable_position int, value string, long binary, shape int, n long, first_row long")
    cells["t"] = [*cells.pop("s"), *cells["t"]]
    held = {k: v for k, v in cells.items() if v}
    rows = table.df.selectExpr("monotonically_increasing_id() AS first_row", *[f"array({', '.join(x for _, x, _ in v)}) AS {k}s" for k, v in held.items()])
    at, start = [], 0
    for k, v in held.items():
        at.append(f"get({k}s, j - {start}) AS {k}")
        start += len(v)
    melted = rows.selectExpr("*", f"explode(sequence(0, {start - 1})) AS j").selectExpr("first_row", f"element_at(array({', '.join(str(i) for v in held.values() for i, *_ in v)}), j + 1) AS variable_position", *at)
    there = {"d": "(d IS NOT NULL AND NOT isnan(d))", "l": "l IS NOT NULL", "t": f"(t IS NOT NULL AND {trimmed('t')} != '')" if table.config["profiling"]["blank_as_missing"] else "t IS NOT NULL"}
    melted = melted.filter(" OR ".join(there[k] for k in held))
    keys = {"d": digits15("d"), "l": "l", "t": "t"}
    if "t" in held and not whole:
        bits = " + ".join(f"if(t RLIKE r'{p}', {1 << k}, 0)" for k, p in enumerate(SHAPES.values()))
        big = f"length(t) > {LONG}"
        keys |= {"t": f"if({big}, substring(t, 1, {LONG}), t)", "long": f"if({big}, unhex(sha2(t, 256)), NULL)", "shape": f"if({big}, {bits}, NULL)"}
        held |= {"long": [], "shape": []}
    grouped = melted.selectExpr("first_row", "variable_position", *[f"{keys[k]} AS {k}" for k in held]).groupBy("variable_position", *held)
    counted = grouped.agg(F.count(F.lit(1)).alias("n"), F.min("first_row").alias("first_row"))
    value: dict[str, list[str]] = {}
    for i, _, text in every:
        value.setdefault(text, []).append(str(i))
    cases = " ".join(f"WHEN variable_position IN ({', '.join(at)}) THEN {text}" for text, at in value.items())
    more = [k if k in held else f"cast(NULL AS {t}) AS {k}" for k, t in (("long", "binary"), ("shape", "int"))]
    return counted.selectExpr("variable_position", f"CASE {cases} END AS value", *more, "n", "first_row")


def first_values(table: Table, k: int, freq: DataFrame | None = None) -> DataFrame:
    """The first k distinct values of each column in order of rows; each task passes on k a column."""
    freq = frequencies(table) if freq is None else freq
    order = Window.partitionBy("variable_position").orderBy("first_row")
    return freq.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def examples(table: Table, freq: DataFrame | None = None) -> DataFrame:
    """variable_position, examples: the first distinct values, joined."""
    from ..functions.columns import truncated

    first = first_values(table, table.config["profiling"]["sample_values"], freq)
    return first.groupBy("variable_position").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", truncated(F.col("value"), 160).alias("v")))), lambda s: s["v"]), " | ").alias("examples"))


def pattern_ratios(table: Table, freq: DataFrame | None = None) -> DataFrame:
    """Shares of e-mail, phone and UUID shapes among the first 500 distinct values of each text column."""
    texts = [i for i, _, f in table.columns() if isinstance(f.dataType, T.StringType)]
    sample = first_values(table, 500, (frequencies(table) if freq is None else freq).filter(F.col("variable_position").isin(*texts)))
    shares = [F.avg(F.when(F.col("long").isNotNull(), F.getbit("shape", F.lit(k)) == 1).otherwise(F.col("value").rlike(p)).cast("double")).alias(f"{name}_ratio") for k, (name, p) in enumerate(SHAPES.items())]
    return sample.groupBy("variable_position").agg(*shares)


def stats(table: Table, freq: DataFrame | None = None) -> DataFrame:
    """basic_stats with distinct counts."""
    freq = frequencies(table) if freq is None else freq
    unique = freq.groupBy("variable_position").agg(F.count(F.lit(1)).alias("n_unique_non_missing"))
    out = basic_stats(table).join(unique, "variable_position", "left").withColumn("n_unique_non_missing", F.coalesce("n_unique_non_missing", F.lit(0)))
    ratio = F.when(F.col("n_non_missing") > 0, F.col("n_unique_non_missing") / F.col("n_non_missing"))
    return out.withColumns({
        "uniqueness_ratio": ratio, "percent_missing": F.when(F.col("n_rows") > 0, 100.0 * F.col("n_missing") / F.col("n_rows")), "is_all_missing": F.col("n_non_missing") == 0,
        "is_constant": F.col("n_unique_non_missing") == 1, "is_all_unique": (F.col("n_non_missing") > 0) & (F.col("n_unique_non_missing") == F.col("n_non_missing")),
    })


def duplicate_rows(df: DataFrame) -> DataFrame:
    """n_rows, duplicate_rows: rows that repeat an earlier one. Rows are shuffled as 128 bits (two seeded 64-bit hashes, which tell nulls by a mask); maps and variants count by their JSON."""
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    cells = [comparable(f.name, f.dataType) for f in flat.schema.fields]
    nulls = f"concat('', {', '.join(f'int({c} IS NULL)' for c in cells)})" if cells else "''"
    groups = flat.selectExpr(*[f"xxhash64({', '.join([str(seed), nulls, *cells])}) AS h{seed}" for seed in (1, 2)]).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def dataset_cells(table: Table, variables: DataFrame | None = None) -> DataFrame:
    """total_cells, missing_cells (system missing), percent_missing_cells, blank_string_cells."""
    total = F.coalesce(F.sum("n_rows"), F.lit(0)).cast("double")
    out = (basic_stats(table) if variables is None else variables).agg(total.alias("total_cells"), F.sum("n_system_missing").cast("double").alias("missing_cells"), F.sum("n_blank_strings").cast("double").alias("blank_string_cells"))
    return out.withColumn("percent_missing_cells", F.when(F.col("total_cells") > 0, 100.0 * F.col("missing_cells") / F.col("total_cells")))


def union_fill(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def limit_rows(df: DataFrame, n_max: float | None) -> DataFrame:
    return df if n_max is None or n_max == float("inf") else df.limit(max(0, int(n_max)))
