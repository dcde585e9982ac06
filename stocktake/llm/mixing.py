"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1. Its integral, scaled to the source's target, is the demand
for the source's words up to each time. Documents of a source stand in a fixed pseudo-random order; the words before a
document are inverted through the demand to the time at which it is due, and documents are range-sorted by that time.
A source whose target exceeds its size is passed through again, and each take of a document is due when the words of its source before
that take, earlier passes included, are spent; where a target ends, the last document is cut.

Defined results: null and empty texts have size 0 and take 0; a null source comes after all others; documents equal in id
and size are interchangeable; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktake.llm.common import staged, table, word_count

#: Relative weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: By weight: knots (time, rate) of the schedule. Heavy sources come early, light ones late.
SCHEDULES = {5: ((0.0, 1.5), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 1: ((0.0, 0.5), (1.0, 1.5))}
#: Hash order is cut into this many parts of each source, so that no source has to meet in one task.
PARTS_HEX = 3


def order_key(doc_id: Column, seed: str = "mix") -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sizes (source, source_size): one row for each source -> also weight and target.

    Targets share `share` times all sizes by weight; none exceeds `most` times its source, the excess goes to the others
    by weight. Sources sorted by how early they fill up: the level at the first that does not is everyone's level.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    base = sizes.withColumn("weight", weight).withColumn("full", F.lit(most) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    levels = base.withColumns({
        "before": F.coalesce(F.sum("full").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.lit(share) * F.sum("source_size").over(everything),
    }).withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    common = F.max(F.when(F.col("level") * F.col("weight") < F.col("full"), F.col("level"))).over(everything)
    return levels.withColumn("common", common).select(
        "source", "source_size", "weight",
        F.coalesce(F.least(F.col("full"), F.col("common") * F.col("weight")), F.col("full")).alias("target"),
    )


def schedule_of(weight: Column, schedules: dict = SCHEDULES) -> Column:
    """Knots of the weight's schedule with the area before each: array<struct<t,w,area>>."""
    out = None
    for w, knots in schedules.items():
        area, rows = 0.0, []
        for k, (t, rate) in enumerate(knots):
            area += (t - knots[k - 1][0]) * (rate + knots[k - 1][1]) / 2 if k else 0.0
            rows.append(F.struct(F.lit(float(t)).alias("t"), F.lit(float(rate)).alias("w"), F.lit(float(area)).alias("area")))
        case = weight == w
        out = F.when(case, F.array(*rows)) if out is None else out.when(case, F.array(*rows))
    return out


def due_time(done: Column, knots: Column) -> Column:
    """The time by which the share `done` (0..1) of a schedule's area is spent: the root of a parabola in its segment."""
    last = F.size(knots)
    area = done * F.element_at(knots, -1)["area"]
    k = F.least(F.size(F.filter(knots, lambda x: x["area"] <= area)), last - 1)
    a, b = F.element_at(knots, k), F.element_at(knots, k + 1)
    rest = area - a["area"]
    slope = (b["w"] - a["w"]) / (b["t"] - a["t"])
    root = a["w"] + F.sqrt(F.greatest(a["w"] * a["w"] + F.lit(2.0) * slope * rest, F.lit(0.0)))
    return F.when(rest <= 0, a["t"]).otherwise(a["t"] + F.lit(2.0) * rest / root)


def place(docs: DataFrame, size: str, source: str = "source", share: float = 1.5, most: float = 2.0, schedules: dict = SCHEDULES) -> DataFrame:
    """docs, which must have doc_id, with source_size, target, taken, positions (of each take, in order) and position (the first; null
    if nothing is taken).

    Two-level running sums: parts of a source's order are summed first, then rows within their part, so a hot source is
    spread over 16**PARTS_HEX tasks.
    """
    keyed = docs.withColumn("_key", order_key(F.col("doc_id"))).withColumn("_part", F.substring("_key", 1, PARTS_HEX))
    # Sources meet null-safe under a name that is never null.
    keyed = keyed.withColumn("_source", F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")))
    parts = staged(keyed.groupBy("_source", F.col(source).alias("_name"), "_part").agg(F.sum(size).alias("part_size")), "mix-parts")
    targets = source_targets(parts.groupBy(F.col("_name").alias("source")).agg(F.sum("part_size").alias("source_size")), share, most)
    targets = targets.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("_source"), "source_size", "target",
        schedule_of(F.col("weight"), schedules).alias("_knots"),
    )
    earlier = F.sum("part_size").over(Window.partitionBy("_source").orderBy("_part")) - F.col("part_size")
    plan = parts.select("_source", "_part", earlier.alias("_earlier")).join(targets, "_source")
    within = Window.partitionBy("_source", "_part").orderBy("_key", size).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = keyed.withColumn("_within", F.sum(size).over(within) - F.col(size))
    n, before = F.col(size), F.col("_earlier") + F.col("_within")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.floor("target") - passes * F.col("source_size")
    taken = (passes * n + F.greatest(F.lit(0), F.least(n, left - before))).cast("long")
    placed = summed.join(plan, ["_source", "_part"]).withColumn("taken", taken)
    takes = F.when(n > 0, (passes + F.when(left > before, 1).otherwise(0)).cast("long")).otherwise(0)
    spent = lambda take: F.least((before + take * F.col("source_size")) / F.col("target"), F.lit(1.0))
    due = F.transform(F.sequence(F.lit(0).cast("long"), takes - 1), lambda take: due_time(spent(take), F.col("_knots")))
    placed = placed.withColumn("positions", F.when(takes > 0, due).otherwise(F.array().cast("array<double>")))
    return placed.withColumn("position", F.get("positions", F.lit(0))).drop("_source", "_part", "_earlier", "_within", "_knots")


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """All documents with size, source_size, target, taken, the positions of their first and last take and of all, range-sorted by the first;
    the unused come last."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    placed = place(sized, "size", share=share, most=most).select(
        "doc_id", "size", "source_size", "target", "taken", "position", F.get("positions", F.size("positions") - 1).alias("last_position"), "positions", "_key"
    )
    return placed.orderBy(F.col("position").asc_nulls_last(), "_key").drop("_key")


def mixed_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents themselves, once for each time the mix takes them (a last take of half a document or more counts),
    range-sorted by training position, with the columns they came with."""
    names = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), "doc_id", "source", word_count(F.col("text")).alias("_size"))
    placed = place(boxed, "_size", share=share, most=most)
    times = F.when(F.col("_size") > 0, F.round(F.col("taken") / F.col("_size"))).otherwise(0).cast("int")
    rows = placed.where(times > 0).withColumn("_take", F.explode(F.sequence(F.lit(1), times)))
    return rows.withColumn("_at", F.get("positions", F.col("_take") - 1)).repartitionByRange("_at", "_key").sortWithinPartitions("_at", "_key").select("_doc.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the contract's weights."""
    return mix(table(spark, sf_dir, "documents")).drop("positions")


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS r FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, CAST(2 AS DOUBLE) * source_size AS full_size FROM sources
), levels AS (
  SELECT *, (CAST(1.5 AS DOUBLE) * sum(source_size) OVER ()
    - coalesce(sum(full_size) OVER (ORDER BY full_size / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY full_size / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, w,
    coalesce(least(full_size, w * max(CASE WHEN level * w < full_size THEN level END) OVER ()), full_size) AS target
  FROM levels
), ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.w,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS p FROM ordered
), takes AS (
  SELECT *, p * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - p * source_size - before)) AS taken FROM passes
), due AS (
  SELECT *, least(before / target, CAST(1 AS DOUBLE)) AS done,
    least((before + CASE WHEN CAST(floor(target) AS BIGINT) - p * source_size > before THEN p ELSE p - 1 END * source_size) / target, CAST(1 AS DOUBLE)) AS last_done,
    CASE w WHEN 5 THEN CAST(1.5 AS DOUBLE) WHEN 2 THEN 1 ELSE 0.5 END AS w0,
    CASE w WHEN 5 THEN CAST(-1 AS DOUBLE) WHEN 2 THEN 0 ELSE 1 END AS slope
  FROM takes
)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
  CASE WHEN taken > 0 THEN CASE WHEN done <= 0 THEN 0 ELSE 2.0 * done / (w0 + sqrt(greatest(w0 * w0 + 2.0 * slope * done, 0))) END END AS position,
  CASE WHEN taken > 0 THEN CASE WHEN last_done <= 0 THEN 0 ELSE 2.0 * last_done / (w0 + sqrt(greatest(w0 * w0 + 2.0 * slope * last_done, 0))) END END AS last_position
FROM due
"""
