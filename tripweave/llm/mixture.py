"""Mixing sources to target weights by a low-discrepancy schedule.

The mix has slots of ``BLOCK`` words, so their number grows with it. Slot i stands at the fractional part of i times the golden
ratio; mapped through the cumulative target shares, the points give every source its slots, spread evenly over the
whole mix and with a count that stays within a few slots of its share. The r-th slot of a source takes the r-th block
of the source's words: its documents in a shuffled order, cut into blocks of equally many words; after the last
document a second pass in another order begins. A mix takes two passes at most.

The slots settle the order, which is where a document's words stand in the mix; the number of words is a source's
rounded target, whatever the length of a block. The last block of a source is cut where its target ends, slots beyond
that are left out, and blocks that got no slot follow at the end of the mix; a source is dealt slots to within a few of
its share, so those are a few of each source.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and share 150% of all words. A target stops
at twice its source's words, and the excess is shared again by weight until none is above.

Null and empty texts have size 0 and are never taken. Sources without words have target 0. An empty table gives empty
results. Repeated rows are documents of their own. Texts of any length are counted whole. Orders are hashes, ties are
settled by the id and the text's hash, so reruns agree. Only the id, source and text are read, so further columns of
any name do not matter.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm.common import WORD_PATTERN, stored, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
BLOCK = 256  # words of a slot
GOLDEN = 0.6180339887498949
BUCKET_ROWS = 20_000  # documents of an order that are summed up together
CHUNK = 4_096  # slots that are ranked together
BINS = 1_024  # of the unit interval, to find the source of a point


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Append ``nth``, the row's place from 0 in a total order, without one task seeing all rows."""
    dealt = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = dealt.groupBy("_part").count().withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_own", own).join(starts.select("_part", "_start"), "_part").withColumn(
        "nth", F.col("_start") + F.col("_own") - 1
    ).drop("_part", "_own", "_start")


def source_targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """``(source, nth, weight, source_size, target)`` of each source."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    sources = numbered(sums, F.col("source").asc_nulls_last()).withColumn(
        "weight", F.get(weights, (F.col("nth") % len(WEIGHTS)).cast("int"))
    )
    sources = stored(sources, "sources")
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.lit(float(PASSES)) * F.col("source_size")
    level, capped = None, -1
    while True:
        # Words per unit of weight among the sources below their caps; it only rises, so each round caps more.
        is_capped = F.lit(False) if level is None else F.lit(level) * F.col("weight") >= cap
        s = sources.agg(
            F.count_if(is_capped).alias("n"), F.sum(F.when(is_capped, cap).otherwise(0.0)).alias("taken"),
            F.sum(F.when(is_capped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if s["n"] == capped or not s["weight"]:
            break
        capped, level = s["n"], (total - s["taken"]) / s["weight"]
    target = F.least(cap, F.lit(level or 0.0) * F.col("weight"))
    return sources.withColumn("target", target.cast("double"))


def shuffled_offsets(sizes: DataFrame, rows: int) -> DataFrame:
    """Append ``start_1`` and ``start_2``: words before the document in its source, in two orders.

    An order is split into buckets of hashes; their sums are added up per source, so a source of any size is spread.
    """
    bits = min(40, max(0, ceil(log2(max(1, rows) / BUCKET_ROWS))))
    out = sizes
    for k in range(1, PASSES + 1):
        h = F.shiftrightunsigned(F.xxhash64(F.lit(k), "doc_id", "size", "mark"), 1)
        out = out.withColumn(f"h{k}", h).withColumn(f"b{k}", F.shiftrightunsigned(F.col(f"h{k}"), 63 - bits))
    for k in range(1, PASSES + 1):
        sums = out.groupBy("nth", f"b{k}").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("nth").orderBy(f"b{k}").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("nth", f"b{k}", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("nth", f"b{k}").orderBy(f"h{k}", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["nth", f"b{k}"])
        out = out.withColumn(f"start_{k}", F.col("base") + F.col("within")).drop("base", "within")
    return out.drop(*[f"{x}{k}" for x in "hb" for k in range(1, PASSES + 1)])


def schedule(spark: SparkSession, targets: DataFrame, slots: int) -> DataFrame:
    """``(slot, nth, block)``: the source of each slot and the block of it that the slot takes."""
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    if not slots or not total:
        return spark.createDataFrame([], "slot long, nth long, block long")
    reach = numbered_shares(targets, total)
    bins = reach.withColumn(
        "bin", F.explode(F.sequence(F.floor(F.col("lo") * BINS), F.least(F.floor(F.col("hi") * BINS), F.lit(BINS - 1))))
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"pmod((id + 0.5D) * {GOLDEN}D, 1.0D)").alias("u"))
    dealt = (
        points.withColumn("bin", F.floor(F.col("u") * BINS)).join(bins, "bin").filter("lo <= u and u < hi")
        .select("slot", "nth", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    )
    counts = dealt.groupBy("nth", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("nth").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("nth", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("nth", "chunk").orderBy("slot"))
    return dealt.withColumn("own", own).join(starts, ["nth", "chunk"]).select("slot", "nth", (F.col("start") + F.col("own") - 1).alias("block"))


def numbered_shares(targets: DataFrame, total: float) -> DataFrame:
    """``(nth, lo, hi)``: the stretch of the unit interval of each source with a target; the last one ends beyond 1."""
    # Sums of the sources' targets, a thousand sources at a time.
    groups = targets.filter("target > 0").withColumn("g", F.floor(F.col("nth") / 1000))
    sums = groups.groupBy("g").agg(F.sum("target").alias("t"))
    base = sums.select("g", F.coalesce(F.sum("t").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("base"))
    inside = F.sum("target").over(Window.partitionBy("g").orderBy("nth"))
    ends = groups.withColumn("end", inside).join(base, "g").select("nth", "target", ((F.col("base") + F.col("end")) / total).alias("hi"))
    last = ends.agg(F.max("nth")).first()[0]
    lo = F.col("hi") - F.col("target") / total
    return ends.select("nth", F.when(lo < 1e-12, 0.0).otherwise(lo).alias("lo"), F.when(F.col("nth") == last, 1.5).otherwise(F.col("hi")).alias("hi"))


def settled(plan: DataFrame, quotas: DataFrame, slots: int) -> DataFrame:
    """The schedule with as many blocks of each source as its ``(nth, blocks)`` says.

    Slots of a source beyond its blocks are left out; its blocks without a slot, which are few, get slots at the end.
    """
    plan = stored(plan, "schedule")
    had = plan.groupBy("nth").agg(F.count("*").alias("had"))
    late = (
        quotas.join(had, "nth", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < blocks")
        .select(F.col("nth").alias("of"), F.explode(F.sequence(F.col("had"), F.col("blocks") - 1)).alias("block"))
    )
    late = numbered(late, F.col("of"), F.col("block")).select((F.col("nth") + slots).alias("slot"), F.col("of").alias("nth"), "block")
    in_time = plan.join(quotas, "nth").filter("block < blocks").select("slot", "nth", "block")
    return stored(in_time.unionByName(late), "settled")


def full_mix(docs: DataFrame, text: str = "text", share: float = SHARE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The mixed documents, and the mix itself.

    The first table has a row for each document: ``doc_id, source, size, source_size, target`` and where it starts in
    the passes over its source. The second has the pieces of the mix: ``slot, nth, doc_id, from_word, words``, the
    document's starts, and whether the block is ``whole`` or the shorter last one of its source.
    """
    sizes = stored(
        docs.select("doc_id", "source", size_of(F.col(text)).alias("size"), F.xxhash64(text).alias("mark")), "sizes"
    )
    targets = stored(source_targets(sizes, share), "targets")
    sums = targets.agg(F.sum("target"), F.sum("source_size")).first()
    rows = sizes.count()
    words = block
    points = ceil((sums[0] or 0.0) / words)
    quotas = targets.filter("target > 0").select("nth", F.greatest(F.round("target"), F.lit(1.0)).cast("long").alias("quota"))
    quotas = quotas.withColumn("blocks", F.expr(f"(quota + {words - 1}) div {words}"))
    plan = settled(schedule(docs.sparkSession, targets, points), quotas.select("nth", "blocks"), points)
    placed = sizes.join(targets.select(F.col("source").alias("s"), "nth", "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = stored(shuffled_offsets(placed, rows), "placed")
    # No quota is above two passes, and no words beyond it are cut.
    passes = F.explode(F.array(*[F.struct((F.col(f"start_{k}") + (k - 1) * F.col("source_size")).alias("at")) for k in range(1, PASSES + 1)]))
    stretches = (
        placed.filter("size > 0").join(quotas, "nth").withColumn("at", passes).withColumn("at", F.col("at.at"))
        .filter(F.col("at") < F.col("quota"))
        .withColumn("block", F.explode(F.sequence(
            F.expr(f"at div {words}"), F.least(F.expr(f"(at + size - 1) div {words}"), F.col("blocks") - 1)
        )))
    )
    first, edge = F.greatest("at", F.col("block") * words), (F.col("block") + 1) * words
    end = F.least(F.col("at") + F.col("size"), edge, F.col("quota"))
    pieces = stretches.select(
        "nth", "block", "doc_id", "mark", "start_1", "start_2", "size", (first - F.col("at")).alias("from_word"),
        (end - first).alias("words"), (edge <= F.col("quota")).alias("whole"),
    ).join(plan, ["nth", "block"])
    return placed, pieces


def mix(docs: DataFrame, text: str = "text", share: float = SHARE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``full_mix`` in blocks of equal length only, without the shorter last block of a source."""
    placed, pieces = full_mix(docs, text, share, block)
    return placed, pieces.filter("whole").drop("whole")


def taken(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, first_slot, slots, source)``: what the mix takes of each document.

    ``first_slot`` is the first slot that holds words of it (null if none does), ``slots`` how many do.
    """
    placed, pieces = full_mix(docs, text, block=block)
    # Two documents of a source never start at the same words, unless they are empty.
    key = ["nth", "start_1", "start_2"]
    # A document that is longer than its source's second pass may meet a slot twice; a slot counts once.
    sums = pieces.groupBy(*key, "slot").agg(F.sum("words").alias("words")).groupBy(*key).agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("slots")
    )
    some = placed.filter("size > 0").join(sums, key, "left")
    none = placed.filter("size = 0").withColumns({"taken": F.lit(0).cast("long"), "first_slot": F.lit(None).cast("long"), "slots": F.lit(0).cast("long")})
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    columns = ["doc_id", "size", "source_size", "target", zero("taken"), "first_slot", zero("slots"), "source"]
    return some.select(*columns).unionByName(none.select(*columns))


def op6_mixture(spark, sf_dir):
    return taken(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
