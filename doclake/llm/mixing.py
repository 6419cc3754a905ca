"""Mixing sources to target weights by Pfair scheduling.

The rows of a source are numbered and cut into blocks. With the target weight
of a source written as n parts of a cycle of Q slots, its block i (from 0) is
released at slot floor(i Q / n) and due by slot ceil((i + 1) Q / n). Earliest
deadline first among the released blocks fills every slot, meets every
deadline, and so keeps each source within less than one block of its weight at
every slot. The schedule repeats after Q slots (releases and deadlines do), so
one cycle of Q slots is worked out, by one SQL fold over the slots, and every
block's slot follows from its number.

``schedule`` marks as ``in_mix`` the blocks before the slot where the first
source runs out, and ``mix`` keeps only those: an early stop for who asks for
it. ``interleave`` places every row: where a source runs out it leaves, and
the others go on at their renormalised weights (the parts they have). The time
between the ends of two sources is a phase. A source of B blocks and n parts
ends after B / n cycles, so the blocks that every source has placed by the end
of a phase are known (to half a block) without the phases before. A phase is
as many whole cycles as fit and one shorter cycle with the rest; EDF keeps each
source within less than one block of its share of each.

Only DataFrame and SQL functions are used; for ``interleave`` one row per
source and phase is worked out, and one per block. A source's rows are numbered
in ``BUCKETS`` buckets of doc_id each, so a source with a third of all rows
spreads over as many tasks.

Defined cases: a null source is a source; rows with a null or equal doc_id are
numbered in any order among themselves; a source without a given weight stays
out of the mix (no slot), a weighted source without rows is left out of the
weights; texts are not read; an empty table gives no rows; extra columns pass
through ``mix`` also under clashing names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, staged

CYCLE = 1000
BLOCK_ROWS = 16
BUCKETS = 1024
# without given weights: a source of n rows weighs n to this power
TEMPERATURE = 0.8


def source_key(name: str = "source"):
    return F.when(F.col(name).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(name).cast("string")))


def cycle_parts(totals: DataFrame, weights: dict | None = None, temperature: float = TEMPERATURE,
                cycle: int = CYCLE) -> DataFrame:
    """``totals(src, n_rows)`` -> ``src, n_rows, parts, cycle``: whole parts of at least 1 that add up to the cycle.

    One row per source. The cycle is raised to four slots per source where
    there are that many sources.
    """
    if weights is None:
        weighed = totals.withColumn("w", F.pow(F.col("n_rows").cast("double"), F.lit(temperature)))
    else:
        given = totals.sparkSession.createDataFrame(
            [("null" if k is None else f"={k}", float(v)) for k, v in weights.items()], "src string, w double")
        weighed = totals.join(F.broadcast(given), "src")
    every = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = weighed.withColumn("sources", F.count(F.lit(1)).over(every)).withColumn(
        "cycle", F.greatest(F.lit(cycle).cast("long"), 4 * F.col("sources"))).withColumn(
        "exact", F.col("w") / F.sum("w").over(every) * (F.col("cycle") - F.col("sources"))).withColumn(
        "low", F.floor("exact"))
    rest = F.col("cycle") - F.col("sources") - F.sum("low").over(every)
    by_rest = Window.partitionBy(F.lit(1)).orderBy(F.desc(F.col("exact") - F.col("low")), "src")
    return share.withColumn("rest", rest).withColumn("rk", F.row_number().over(by_rest)).select(
        "src", "n_rows", (1 + F.col("low") + F.when(F.col("rk") <= F.col("rest"), 1).otherwise(0)).alias("parts"), "cycle")


def edf_cycle(parts: DataFrame, *by: str) -> DataFrame:
    """``src, parts, cycle, turn, at``: the slot of each source's blocks in one cycle (one of each ``by``)."""
    one = parts.groupBy("cycle", *by).agg(F.sort_array(F.collect_list(F.struct("src", "parts"))).alias("s"))
    # state: blocks done per source, and the source of every slot so far
    folded = one.withColumn("slots", F.expr("""
      aggregate(
        sequence(0L, cycle - 1),
        named_struct('done', transform(s, x -> 0L), 'slots', array_repeat(0, 0)),
        (a, t) -> transform(
          array(array_min(filter(
            transform(s, (x, i) -> named_struct(
              'due', ((a.done[i] + 1) * cycle + x.parts - 1) div x.parts, 'i', i,
              'free', a.done[i] < x.parts and (a.done[i] * cycle) div x.parts <= t)),
            x -> x.free)).i),
          p -> named_struct('done', transform(a.done, (d, i) -> d + if(i = p, 1L, 0L)),
                            'slots', concat(a.slots, array(p))))[0],
        a -> a.slots)"""))
    slots = folded.select("cycle", *by, "s", F.posexplode("slots").alias("at", "i")).select(
        "cycle", *by, F.expr("s[i].src").alias("src"), F.expr("s[i].parts").alias("parts"), F.col("at").cast("long"))
    return slots.withColumn("turn", F.row_number().over(Window.partitionBy("src", *by).orderBy("at")).cast("long") - 1)


def _numbered(docs: DataFrame, src: str, bucket: str, idx: str, before: str) -> tuple[DataFrame, DataFrame]:
    """Rows per source and bucket; ``docs`` with the number of a row in its bucket and of the rows in earlier ones."""
    keyed = docs.withColumn(src, source_key()).withColumn(
        bucket, F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(BUCKETS)))
    counts = staged(docs.select(source_key().alias("src"), F.pmod(
        F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(BUCKETS)).alias("bucket")).groupBy("src", "bucket").agg(
        F.count(F.lit(1)).alias("n")), "bucket-counts")
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("src", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy(src, bucket).orderBy("doc_id"))
    return counts, (keyed.withColumn(idx, number)
                    .join(offsets.select(F.col("src").alias(src), F.col("bucket").alias(bucket),
                                         F.col("before").alias(before)), [src, bucket]))


def schedule(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS,
             temperature: float = TEMPERATURE, cycle: int = CYCLE) -> DataFrame:
    """``docs`` with ``block, release, due, slot`` (of the row's block) and ``in_mix``."""
    names = fresh(docs, "block", "release", "due", "slot", "in_mix", "src", "bucket", "idx", "before",
                  "n_rows", "parts", "cycle", "turn", "at", "until")
    block, release, due, slot, in_mix, src, bucket, idx, before, n_rows, parts_c, cycle_c, turn, at, until = names
    counts, numbered = _numbered(docs, src, bucket, idx, before)
    totals = counts.groupBy("src").agg(F.sum("n").alias("n_rows"))
    table = staged(edf_cycle(cycle_parts(totals, weights, temperature, cycle)), "cycle")
    # the slot at which each source would need the block after its last one
    ends = totals.join(table, "src").withColumn("blocks", F.ceil(F.col("n_rows") / F.lit(block_rows))).where(
        F.col("turn") == F.col("blocks") % F.col("parts")).select(
        "cycle", (F.expr("blocks div parts") * F.col("cycle") + F.col("at")).alias("end"))
    horizon = ends.groupBy("cycle").agg(F.min("end").alias("until"))
    # one row per slot of the cycle, and per source and bucket: sizes set by parameters and the number of sources
    place = F.broadcast(table.join(horizon, "cycle").select(
        F.col("src").alias(src), F.col("parts").alias(parts_c), F.col("cycle").alias(cycle_c),
        F.col("turn").alias(turn), F.col("at").alias(at), F.col("until").alias(until)))
    sized = F.broadcast(table.select(F.col("src").alias(src), F.col("parts").alias(n_rows)).distinct())
    numbered = (numbered
                .withColumn(block, F.expr(f"(`{before}` + `{idx}` - 1) div {block_rows}"))
                .join(sized, src, "left")
                .withColumn(turn, F.col(block) % F.col(n_rows)))
    placed = numbered.join(place, [src, turn], "left")
    return placed.select(
        *[F.col(f"`{c}`") for c in docs.columns], block,
        F.expr(f"(`{block}` * `{cycle_c}`) div `{parts_c}`").alias(release),
        F.expr(f"((`{block}` + 1) * `{cycle_c}` + `{parts_c}` - 1) div `{parts_c}`").alias(due),
        F.expr(f"(`{block}` div `{parts_c}`) * `{cycle_c}` + `{at}`").alias(slot),
        F.expr(f"coalesce((`{block}` div `{parts_c}`) * `{cycle_c}` + `{at}` < `{until}`, false)").alias(in_mix))


def mix(docs: DataFrame, weights: dict | None = None, **options) -> DataFrame:
    """The early stop: only the rows of ``docs`` up to the slot where the first source runs out."""
    mark = fresh(docs, "block", "release", "due", "slot", "in_mix")[-1]
    return schedule(docs, weights, **options).where(F.col(mark)).select(*[F.col(f"`{c}`") for c in docs.columns])


def phase_cycles(parts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``phase, rest, src, parts, cycle, first, start, times``: the cycles of every phase, of the sources ``src,
    n_rows, parts``. A cycle begins at slot ``start``, with a source's block ``first``, and stands ``times`` times."""
    own = parts.select("src", F.col("parts").cast("long").alias("p"),
                       F.ceil(F.col("n_rows") / F.lit(block_rows)).cast("long").alias("b"))
    ends = own.select(F.col("src").alias("phase"), F.col("p").alias("pe"), F.col("b").alias("be"))
    # blocks of every source when source ``phase`` ends, at b / p cycles
    upto = own.crossJoin(F.broadcast(ends)).withColumn("upto", F.expr(
        "if(b * pe <= be * p, b, least(b, (2 * p * be + pe) div (2 * pe)))")).withColumn("v", F.expr("be / pe"))
    by_end = Window.partitionBy("src").orderBy("v", "phase")
    of_phase = Window.partitionBy("phase")
    grown = (upto.withColumn("first", F.coalesce(F.lag("upto").over(by_end), F.lit(0).cast("long")))
             .withColumn("start", F.sum("first").over(of_phase))
             .where("first < b").withColumn("m", F.col("upto") - F.col("first"))
             .withColumn("times", F.min(F.expr("m div p")).over(of_phase))
             .withColumn("q", F.sum("p").over(of_phase)))
    both = grown.select("phase", "src", F.explode(F.expr("""array(
        named_struct('rest', 0, 'parts', p, 'first', first, 'start', start, 'times', times),
        named_struct('rest', 1, 'parts', m - times * p, 'first', first + times * p, 'start', start + times * q,
                     'times', 1L))""")).alias("x")).select("phase", "src", "x.*").where("times > 0 and parts > 0")
    return both.withColumn("cycle", F.sum("parts").over(Window.partitionBy("phase", "rest")))


def block_slots(parts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``src, n_rows, parts`` of every source -> ``src, block, slot`` of every block."""
    cycles = staged(phase_cycles(parts, block_rows), "phases")
    return (edf_cycle(cycles.select("phase", "rest", "src", "parts", "cycle"), "phase", "rest").drop("parts", "cycle")
            .join(cycles, ["phase", "rest", "src"]).withColumn("c", F.explode(F.expr("sequence(0L, times - 1)")))
            .select("src", F.expr("first + c * parts + turn").alias("block"), F.expr("start + c * cycle + at").alias("slot")))


def interleave(docs: DataFrame, weights: dict | None = None, block_rows: int = BLOCK_ROWS,
               temperature: float = TEMPERATURE, cycle: int = CYCLE) -> DataFrame:
    """All rows of ``docs`` with the slot of their block as last column (``mix_slot``, or with ``_`` in front)."""
    slot, src, bucket, idx, before, block = fresh(docs, "mix_slot", "src", "bucket", "idx", "before", "block")
    counts, numbered = _numbered(docs, src, bucket, idx, before)
    totals = counts.groupBy("src").agg(F.sum("n").alias("n_rows"))
    slots = staged(block_slots(cycle_parts(totals, weights, temperature, cycle), block_rows), "block-slots")
    return (numbered.withColumn(block, F.expr(f"(`{before}` + `{idx}` - 1) div {block_rows}"))
            .join(slots.select(F.col("src").alias(src), F.col("block").alias(block), F.col("slot").alias(slot)),
                  [src, block], "left")
            .select(*[F.col(f"`{c}`") for c in docs.columns], slot))


def mixed(docs: DataFrame, weights: dict | None = None, **options) -> DataFrame:
    """All rows of ``docs`` in the order of their slots."""
    placed = interleave(docs, weights, **options)
    slot = placed.columns[-1]
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartitionByRange(parts, slot, "doc_id").sortWithinPartitions(slot, "doc_id").select(
        *[F.col(f"`{c}`") for c in docs.columns])
