"""Mixing sources to target weights as a time-varying curriculum. DataFrame functions only.

Targets: sources, ordered by code point with null last, weigh 3, 1, 2, repeating. They share 150 % of all words; a target
stops at twice its source's words, and the excess is shared again by weight until none is above (water filling, solved in
closed form over the sources ordered by capacity per weight).

Curriculum: training time runs from 0 to 1. Source s is drawn at rate target_s * (a_s + (b_s - a_s) t), where (a_s, b_s)
is its weight schedule, scaled to (a_s + b_s) / 2 = 1. Its integral, target_s * (a_s t + (b_s - a_s) t^2 / 2), is the
source's cumulative demand. A source's documents lie in a fixed random order (md5 of the id, then id and size) on the
axis of its words, which is run through up to twice. In each pass the demand up to a document's first word is inverted for its
time, and the time gives its position among all training tokens: `position` in the first pass, `again` in the second, each null
where the pass takes no word of the document. Documents are range-sorted by position, those that are not taken last;
`training_order` gives a row for each taken pass, range-sorted.

taken: of each pass over a source, the part of a document's words that lies before the target. Sums of taken are each
target rounded down; a document gives at most its size in each of two passes.

Scale: the running word count of a source is a two-level prefix sum: documents fall into buckets of about BUCKET rows by
their hash, buckets are summed before the shuffle, and only one row for each bucket is put in order within its source.
No task holds a source. The source table has one row for each source and is the only thing ordered in one place.

Nulls and edge cases: null or empty text has size 0, takes 0 words and has no position. Very long texts are counted whole.
A null source is a source, the last. Null and repeated ids are allowed; rows that are equal in id and size are
interchangeable. An empty table gives an empty result. Clashing input columns are replaced by ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.scratch import stash


BUCKET = 2000
WEIGHTS = (3, 1, 2)
#: Rate of each source at the start and the end of training, repeating like the weights.
SCHEDULE = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def word_count(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _pick(rank: Column, values: tuple) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> rank, weight and target of each source; total: words of all."""
    every = Window.partitionBy()
    by_room = Window.orderBy("room", "rank")
    low, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    s = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", _pick(F.col("rank"), WEIGHTS)).withColumn("total", F.sum("source_size").over(every))
    s = s.withColumn("room", 2 * F.col("source_size") / F.col("weight"))
    # what a weight of 1 gets if all sources with less room are full
    s = s.withColumn("share", (3 * F.col("total") - 4 * F.coalesce(F.sum("source_size").over(low), F.lit(0))) / (2 * F.sum("weight").over(rest)))
    s = s.withColumn("level", F.min(F.when(F.col("share") <= F.col("room"), F.struct("room", "rank", "share"))).over(every)["share"])
    s = s.withColumn("target", F.when(F.col("level").isNull() | (F.col("room") <= F.col("level")), (2 * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.col("level")))
    a, b = (_pick(F.col("rank"), tuple(x[k] for x in SCHEDULE)) for k in (0, 1))
    s = s.withColumn("a", 2 * a / (a + b)).withColumn("b", 2 * b / (a + b))
    # words of all sources up to time t: flow * t + bend * t^2
    end = F.floor("target")  # whole words, so that sums don't depend on their order
    s = s.withColumn("flow", F.sum(end * F.col("a")).over(every)).withColumn("bend", F.sum(end * (F.col("b") - F.col("a")) / 2).over(every))
    return s.select("source", "source_size", "target", "a", "b", "flow", "bend")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """One row per document, range-sorted by position: carry, size, source_size, target, taken, position, again.

    carry: columns of docs to keep; by default all but the text, which then is read once and never shuffled.
    """
    kept = [c for c in (carry or [c for c in docs.columns if c != text_col]) if c not in ("size", "source_size", "target", "taken", "position", "again")]
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(*kept, word_count(F.col(text_col)).alias("size"), F.struct(F.col(source_col).alias("source"), key.alias("key"), F.col(id_col).alias("id")).alias("_x"))
    if text_col not in kept:
        rows = stash(rows, "sizes")
    light = rows.select("_x.*", "size")
    count = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    count = stash(count, "source-sizes")
    plan = source_targets(count.select("source", "source_size")).join(count.select(F.col("source").alias("s"), "n"), F.expr("source <=> s")).drop("s")
    plan = stash(plan.withColumn("buckets", F.expr(f"cast(ceil(n / {BUCKET}.0) as long)")), "source-plan")

    def bucket(buckets: str) -> Column:
        return F.floor(F.conv(F.substring("key", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48)) * F.col(buckets)).cast("long")

    p = plan.select(F.struct("*").alias("p"))
    dealt = rows.select(*kept, "size", "_x").join(p, F.col("_x.source").eqNullSafe(F.col("p.source")))
    dealt = dealt.withColumn("key", F.col("_x.key")).withColumn("buckets", F.col("p.buckets")).withColumn("_b", bucket("buckets")).drop("key", "buckets")
    sums = light.join(plan.select(F.col("source").alias("s"), "buckets"), F.expr("source <=> s")).withColumn("b", bucket("buckets")).groupBy("s", "b").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.struct("s", "b", F.coalesce(before, F.lit(0)).alias("before")).alias("o"))
    within = F.sum("size").over(Window.partitionBy(F.col("_x.source"), "_b").orderBy("_x.key", "_x.id", "size").rowsBetween(Window.unboundedPreceding, -1))
    dealt = dealt.withColumn("_w", F.coalesce(within, F.lit(0)))
    dealt = dealt.join(sums, F.col("_x.source").eqNullSafe(F.col("o.s")) & (F.col("_b") == F.col("o.b"))).withColumn("_c", F.col("o.before") + F.col("_w"))
    end = F.floor("p.target").cast("long")
    zero = F.lit(0).cast("long")

    def part(at: Column) -> Column:
        return F.greatest(zero, F.least(F.col("size"), end - at))

    a, b = F.col("p.a"), F.col("p.b")

    def position(at: Column) -> Column:
        c = F.try_divide(at, end)
        t = F.when(a == b, c).otherwise((F.sqrt(a * a + 2 * (b - a) * c) - a) / (b - a))
        return F.when(part(at) > 0, F.floor(F.col("p.flow") * t + F.col("p.bend") * t * t).cast("long"))

    one, two = F.col("_c"), F.col("_c") + F.col("p.source_size")
    out = dealt.select(*kept, "size", F.col("p.source_size").alias("source_size"), F.col("p.target").alias("target"), (part(one) + part(two)).alias("taken"), position(one).alias("position"), position(two).alias("again"))
    order = [F.coalesce("position", F.lit((1 << 63) - 1)), F.col(id_col)] if id_col in kept else [F.coalesce("position", F.lit((1 << 63) - 1))]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def training_order(mixed: DataFrame) -> DataFrame:
    """mixed of `mix_sources` -> a row for each pass that takes words of a document: its columns, with `at` for position and
    again, and `words` for taken; range-sorted by at."""
    kept = [c for c in mixed.columns if c not in ("position", "again", "taken")]
    first = F.least("size", "taken")
    passes = F.array(F.struct(F.col("position").alias("at"), first.alias("words")), F.struct(F.col("again").alias("at"), (F.col("taken") - first).alias("words")))
    rows = mixed.select(*kept, F.explode(passes).alias("_p")).select(*kept, "_p.at", "_p.words").where("at is not null")
    return rows.repartitionByRange("at").sortWithinPartitions("at")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, CASE r % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS a,
    CASE r % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS b, sum(source_size) OVER ()::BIGINT AS total FROM s),
x AS (SELECT *, (2 * source_size)::DOUBLE / weight AS room FROM w),
y AS (SELECT *, (3 * total - 4 * coalesce(sum(source_size) OVER (ORDER BY room, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE
    / (2 * sum(weight) OVER (ORDER BY room, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT::DOUBLE AS share FROM x),
z AS (SELECT *, (SELECT arg_min(share, (room, r)) FROM y WHERE share <= room) AS level FROM y),
p AS (SELECT source, source_size, a, b, CASE WHEN level IS NULL OR room <= level THEN (2 * source_size)::DOUBLE ELSE weight * level END AS target FROM z),
f AS (SELECT *, floor(target)::BIGINT AS e, sum(floor(target) * a) OVER () AS flow, sum(floor(target) * (b - a) / 2) OVER () AS bend FROM p),
c AS (SELECT d.doc_id, d.size, f.source_size, f.target, e, a, b, flow, bend,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS one
    FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
g AS (SELECT *, greatest(0, least(size, e - one)) AS n, greatest(0, least(size, e - one - source_size)) AS m, one::DOUBLE / nullif(e, 0) AS x, (one + source_size)::DOUBLE / nullif(e, 0) AS y FROM c),
t AS (SELECT *, CASE WHEN n = 0 THEN NULL WHEN a = b THEN x ELSE (sqrt(a * a + 2 * (b - a) * x) - a) / (b - a) END AS u,
    CASE WHEN m = 0 THEN NULL WHEN a = b THEN y ELSE (sqrt(a * a + 2 * (b - a) * y) - a) / (b - a) END AS v FROM g)
SELECT doc_id, size, source_size, target, (n + m)::BIGINT AS taken, floor(flow * u + bend * u * u)::BIGINT AS position, floor(flow * v + bend * v * v)::BIGINT AS again FROM t
"""
