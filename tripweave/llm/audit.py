"""Audit of how filters interact, by higher-order SQL folds.

A document fails some of the filters A to E; that is a mask of five bits. Documents are counted by part (their source)
and mask first, at most 32 cells a part. Each cell then folds across the array of all 120 orders: ``transform`` visits
the orders, ``aggregate`` walks the steps of one and notes what becomes of the cell's documents at each. The 600
structs of a cell, weighted with its counts, are merged into those of its part by elementwise sums. The array of orders
is a constant of the plan and reaches tasks with it.

Filters: A has fewer than 50 words; B has less than 65% distinct words; C has more than 5% of its characters in A-Z;
D holds one of ``#$%&*|``; E has the same text as a row with a smaller id, anywhere in the table.

Null and empty texts are one text without words; they fail A, and E beyond the smallest id. Repeated rows count each;
rows that share the smallest id of a text do not fail E. A row without an id has no smaller one, and is none for
others, so it never fails E; it has no labels. A null source is the part ''. A label repeated for an id counts if any
of its rows says 1. Texts of any length are judged whole and told apart by SHA-256. An empty table gives no rows. Only
``doc_id, text, source`` and ``doc_id, quality, toxic`` are read, so further columns of any name do not matter.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import ASCII_SPACE, table

LETTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65  # percent of the words
MAX_CAPITALS = 5  # percent of the characters
SYMBOLS = r"[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: whether the text fails A, B, C and D."""
    words = F.array_remove(F.split(text, f"[{ASCII_SPACE}]+"), "")
    n = F.size(words).cast("long")
    distinct = F.size(F.array_distinct(words)).cast("long")
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    fails = [
        n < MIN_WORDS,
        100 * distinct < MIN_DISTINCT * n,
        100 * capitals > MAX_CAPITALS * F.char_length(text).cast("long"),
        F.regexp_like(text, F.lit(SYMBOLS)),
    ]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part by the filters they fail.

    Copies of a text are counted per part before they meet, so a text that fills the table is a few rows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text_mask(whole).alias("mask"), F.unhex(F.sha2(whole, 256)).alias("digest"),
    )
    nameless = rows.filter("doc_id is null").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")
    )
    marks = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    no = F.lit(False)
    same = (
        rows.filter("doc_id is not null").groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
        .join(marks, "doc_id", "left")
        .groupBy("digest", "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
        .agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    )
    # The rows under the smallest id of the text pass E, all others fail it.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    split = same.withColumn("passing", passing).select(
        "part", "good", "toxic",
        F.explode(F.array(
            F.struct(F.col("mask"), F.col("passing").alias("n")),
            F.struct((F.col("mask") + (1 << LETTERS.index("E"))).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
        )).alias("c"),
    )
    n = F.col("c.n")
    named = split.filter(n > 0).groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
    )
    return named.unionByName(nameless).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """What each step of each order of the filters does, from ``cells``; a row per part, order and step."""
    k = len(letters)
    orders = list(permutations(range(k)))
    folded = f"array({', '.join(f'array({", ".join(map(str, o))})' for o in orders)})"
    names = f"array({', '.join(repr(''.join(letters[f] for f in o)) for o in orders)})"
    kinds = ", ".join(f"{c}: bigint" for c in COUNTS)
    fails = "getbit(mask, f) = 1"
    step = f"""named_struct(
        'kept', if(acc.alive and not {fails}, n, 0L), 'removed', if(acc.alive and {fails}, n, 0L),
        'redundant', if(not acc.alive and {fails}, n, 0L), 'unique_fails', if(mask = shiftleft(1, f), n, 0L),
        'good_lost', if(acc.alive and {fails}, good, 0L), 'toxic_lost', if(acc.alive and {fails}, toxic, 0L))"""
    walk = f"""aggregate(o,
        named_struct('alive', true, 'steps', cast(array() as array<struct<{kinds}>>)),
        (acc, f) -> named_struct('alive', acc.alive and not {fails}, 'steps', array_append(acc.steps, {step})),
        acc -> acc.steps)"""
    weighted = counted.select("part", F.expr(f"flatten(transform({folded}, o -> {walk}))").alias("steps"))
    sums = ", ".join(f"'{c}', a.{c} + b.{c}" for c in COUNTS)
    zeros = f"array_repeat(named_struct({', '.join(f"'{c}', 0L" for c in COUNTS)}), {len(orders) * k})"
    merged = weighted.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(
        "part", F.expr(f"aggregate(cells, {zeros}, (x, y) -> zip_with(x, y, (a, b) -> named_struct({sums})))").alias("steps")
    )
    rows = merged.select("part", F.posexplode("steps").alias("at", "s")).select(
        "part", F.expr(f"{names}[at div {k}]").alias("filter_order"), (F.col("at") % k + 1).alias("step"), "s.*"
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))


def op12_filter_audit(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audit(cells(docs.select("doc_id", "text", "source"), labels.select("doc_id", "quality", "toxic")))


OP12_SQL = r"""
with docs as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents
), words as (
    select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from docs
), marks as (
    select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id
), judged as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, {
        'A': len(w) < 50,
        'B': 100 * len(list_distinct(w)) < 65 * len(w),
        'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'),
        'E': coalesce(words.doc_id > min(words.doc_id) over (partition by t), false)
    } as f
    from words left join marks on words.doc_id = marks.doc_id
), profiles as (
    select part, map {'A': f.A, 'B': f.B, 'C': f.C, 'D': f.D, 'E': f.E} as fails,
        count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from judged group by 1, 2
), letters as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as l
), orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order
    from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l)
        join letters d on d.l not in (a.l, b.l, c.l) join letters e on e.l not in (a.l, b.l, c.l, d.l)
), steps as (
    select filter_order, cast(unnest(range(1, 6)) as integer) as step from orders
), seen as (
    select part, filter_order, step, n, good, toxic, filter_order[step] as own, fails[filter_order[step]] as failed,
        len(list_filter(string_split(left(filter_order, step - 1), ''), lambda x: x <> '' and fails[x])) > 0 as earlier,
        len(list_filter(map_values(fails), lambda x: x)) = 1 as single
    from profiles cross join steps
), summed as (
    select part, filter_order, step, own,
        cast(sum(case when not earlier and not failed then n else 0 end) as bigint) as kept,
        cast(sum(case when not earlier and failed then n else 0 end) as bigint) as removed,
        cast(sum(case when earlier and failed then n else 0 end) as bigint) as redundant,
        cast(sum(case when single and failed then n else 0 end) as bigint) as unique_fails,
        cast(sum(case when not earlier and failed then good else 0 end) as bigint) as good_lost,
        cast(sum(case when not earlier and failed then toxic else 0 end) as bigint) as toxic_lost
    from seen group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    cast(sum(removed) over (partition by part, own) as bigint) as shapley
from summed
"""
