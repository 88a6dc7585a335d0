"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations alone.

A source's weight is a schedule over training time 0 to 1, linear between knots. Its integral is the source's
weight; integrals share the budget, and targets above max_repeats times a source's size stop there while the
excess goes to the others by weight (the level at which the sum of least(cap, weight x level) is the budget, found
with running sums over the sources in order of cap to weight). Demand accumulated along the schedule is inverted
in closed form: words that are the middle of the u-th part of their source's target stand at the time when the
schedule has asked for u. Documents of a source follow each other by the MD5 of their identifier, and where the
target is larger than the source, pass after pass: pass t of a document has t times the source's size before it, so
each pass has a position of its own and repeats mix with the first passes of other sources as the schedules say.

Running sums within a source use buckets of that MD5, as many as the source needs, so a source with a third of
all rows is spread over many tasks. The table of sources (a row each, weights being given by hand or by rank) is
the only one that is ordered in a single task.

Defined results: null or empty texts have size 0, take 0 words and stand nowhere (null position). A null source is
a source, the last. Rows that repeat an identifier are rows like others; where rows share or lack one, mix() tells
them apart by a row number in a written copy. A null identifier has the MD5 of the text. Documents of equal MD5 stand
by identifier, then size; equal positions of different sources by identifier. Very long texts count whole, and a text
longer than what is left of its source's target is taken in part. Empty tables give empty results; sources of size 0
have target 0. Other columns, whatever their names, pass through mix().
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, fresh, keyed_rows, leaf_mask, leaf_of, named, with_leaves

#: Rows of a source in a bucket of running sums, and buckets of a source at most.
BUCKET_ROWS, BUCKETS = 2_000, 4096


@dataclass(frozen=True)
class Curriculum:
    """Weights at the knots for the first, second ... source in order; repeating. The budget is `share` times all words."""

    knots: tuple[float, ...] = (0.0, 0.5, 1.0)
    schedules: tuple[tuple[float, ...], ...] = ((7.0, 5.0, 3.0), (1.0, 2.0, 3.0), (0.5, 1.0, 1.5))
    max_repeats: int = 3
    share: float = 1.0

    def demands(self, schedule: tuple[float, ...]) -> list[float]:
        """Words asked for up to each knot, per unit of time and weight."""
        out = [0.0]
        for i in range(1, len(self.knots)):
            out.append(out[-1] + (self.knots[i] - self.knots[i - 1]) * (schedule[i] + schedule[i - 1]) / 2)
        return out

    @property
    def weights(self) -> list[float]:
        return [self.demands(s)[-1] for s in self.schedules]

    def time_of(self, kind: Column, part: Column) -> Column:
        """When schedule number `kind` has asked for the given part, 0 to 1, of all that it asks for."""
        whole = F.lit(None).cast("double")
        for i, weights in enumerate(self.schedules):
            sums = self.demands(weights)
            asked, found = part * F.lit(sums[-1]), F.lit(None).cast("double")
            for j in reversed(range(len(self.knots) - 1)):
                slope = (weights[j + 1] - weights[j]) / (self.knots[j + 1] - self.knots[j])
                beyond = asked - F.lit(sums[j])
                at = F.lit(self.knots[j]) + F.lit(2.0) * beyond / (F.lit(weights[j]) + F.sqrt(F.lit(weights[j] * weights[j]) + F.lit(2.0 * slope) * beyond))
                found = F.when(asked < F.lit(sums[j + 1]), at).otherwise(found) if j < len(self.knots) - 2 else at
            whole = F.when(kind == i, found).otherwise(whole)
        return whole


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, plan: Curriculum) -> DataFrame:
    """source, source_rank, kind, source_size, source_rows, leaves, target: a row for each source of (source, size, leaf)."""
    own = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"), leaf_mask(F.col("leaf")).alias("leaves"))
    ranked = own.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    kind = F.pmod("source_rank", F.lit(len(plan.schedules)))
    weights = F.element_at(F.array(*[F.lit(w) for w in plan.weights]), (kind + 1).cast("int"))
    limits = ranked.withColumns({"kind": kind, "weight": weights, "cap": (F.col("source_size") * plan.max_repeats).cast("double")})
    everything = Window.partitionBy()
    below = Window.orderBy(F.col("cap") / F.col("weight"), "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(plan.share)
    level = (budget - F.coalesce(F.sum("cap").over(below), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    levels = limits.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return levels.withColumn("target", F.least("cap", F.col("weight") * F.col("level"))).drop("weight", "cap", "level")


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, plan: Curriculum, row_col: str | None = None) -> DataFrame:
    """training_plan() in any order, with positions (of all passes) and the column that tells rows apart, if given, as row."""
    own = ["row"] if row_col else []
    code = F.md5(F.coalesce(named(id_col).cast("string"), named(text_col), F.lit("")))
    sized = docs.select(named(id_col).alias("doc_id"), named(source_col).alias("source"), word_count(named(text_col)).alias("size"), code.alias("code"), *[named(row_col).alias(o) for o in own])
    sized = cut(sized.withColumn("leaf", leaf_of(F.col("code"))))
    sources = cut(targets(sized, plan))
    buckets = F.least(F.lit(BUCKETS), F.ceil(F.col("source_rows") / BUCKET_ROWS))
    bucket = F.floor(F.conv(F.substring("code", 1, 3), 16, 10).cast("long") * buckets / 4096).cast("int")
    rows = sized.alias("d").join(with_leaves(sources, "leaves", "leaf").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.leaf") == F.col("s.leaf")))
    rows = rows.select("d.*", "s.source_rank", "s.kind", "s.source_size", "s.target", bucket.alias("bucket"))
    sums = rows.groupBy("source_rank", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.select("source_rank", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("source_rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_bucket"))
    within = Window.partitionBy("source_rank", "bucket").orderBy("code", "doc_id", "size", *own).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["source_rank", "bucket"])
    before = F.col("before") + F.col("before_bucket")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target") + 0.5).cast("long") - full * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(rest - before, F.col("size")))
    rows = rows.withColumns({"before": before, "full": full, "part": part})
    taken = F.col("full") * F.col("size") + F.col("part")
    passes = F.when(taken > 0, F.col("full") + (F.col("part") > 0).cast("long")).otherwise(F.lit(0))
    # Pass t, from 0, takes the whole document while t < full, then the part that is left.
    middle = lambda t: t * F.col("source_size") + F.col("before") + F.when(t < F.col("full"), F.col("size")).otherwise(F.col("part")) / 2
    at = lambda t: plan.time_of(F.col("kind"), F.least(F.lit(1.0), middle(t) / F.col("target")))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), at)
    rows = rows.withColumns({"taken": taken, "passes": passes}).withColumn("positions", F.when(F.col("passes") > 0, every))
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken", "passes", F.get("positions", F.lit(0)).alias("position"), F.element_at("positions", -1).alias("last_position"), "positions", *own)


def training_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", plan: Curriculum | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, passes, position and last_position (of the first and the last pass), each row of docs once; in order of position.

    Whole passes over a source come first; what is left of its target is taken from its documents in turn, the last
    of them in part. So the words taken from a source miss its target by less than one word.
    """
    out = _planned(docs, id_col, text_col, source_col, plan or Curriculum()).drop("positions")
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", plan: Curriculum | None = None) -> DataFrame:
    """docs as training meets them: a row for each pass over a document, range-sorted by the pass's position; rows of which the mix takes nothing are gone."""
    keyed, row = keyed_rows(docs, id_col)
    places, place, key = fresh(keyed, "_positions", "_position", "_key")
    planned = _planned(keyed, id_col, text_col, source_col, plan or Curriculum(), row)
    chosen = planned.filter(F.col("passes") > 0).select(F.col("row").alias(key), F.col("positions").alias(places))
    rows = keyed.join(chosen, named(row) == F.col(key)).withColumn(place, F.explode(F.col(places)))
    return rows.orderBy(place, key).select(*[named(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, text, '')) AS code FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM d GROUP BY source
), c AS (
  SELECT *, source_rank % 3 AS kind, [5.0::DOUBLE, 2.0, 1.0][source_rank % 3 + 1] AS weight, (source_size * 3)::DOUBLE AS cap FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM c WINDOW b AS (ORDER BY cap / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, kind, least(cap, weight * max(level) OVER ()) AS target FROM l
), r AS (
  SELECT d.*, t.source_size, t.kind, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY code, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, greatest(0, least(floor(target + 0.5)::BIGINT - whole * source_size - before, size))::BIGINT AS part FROM r
), k AS (
  SELECT *, (whole * size + part)::BIGINT AS taken, CASE WHEN whole * size + part > 0 THEN whole + (part > 0)::BIGINT ELSE 0 END AS passes,
         [5.0::DOUBLE, 2.0, 1.0][kind + 1] AS asked_in_all, [7.0::DOUBLE, 1.0, 0.5][kind + 1] AS w0, [5.0::DOUBLE, 2.0, 1.0][kind + 1] AS w1, [-4.0::DOUBLE, 2.0, 1.0][kind + 1] AS slope, [3.0::DOUBLE, 0.75, 0.375][kind + 1] AS half
  FROM p
), m AS (
  SELECT *, least(1.0::DOUBLE, (before + (CASE WHEN whole > 0 THEN size ELSE part END)::DOUBLE / 2) / target) * asked_in_all AS first,
         least(1.0::DOUBLE, ((passes - 1) * source_size + before + (CASE WHEN part > 0 THEN part ELSE size END)::DOUBLE / 2) / target) * asked_in_all AS last FROM k
)
SELECT doc_id, source, size, source_size, target, taken, passes,
       CASE WHEN taken = 0 THEN NULL WHEN first < half THEN 0.0 + 2.0 * first / (w0 + sqrt(w0 * w0 + 2.0 * slope * first))
            ELSE 0.5 + 2.0 * (first - half) / (w1 + sqrt(w1 * w1 + 2.0 * slope * (first - half))) END AS position,
       CASE WHEN taken = 0 THEN NULL WHEN last < half THEN 0.0 + 2.0 * last / (w0 + sqrt(w0 * w0 + 2.0 * slope * last))
            ELSE 0.5 + 2.0 * (last - half) / (w1 + sqrt(w1 * w1 + 2.0 * slope * (last - half))) END AS last_position
FROM m
"""
