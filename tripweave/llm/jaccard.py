"""Near-duplicate texts by an exact Jaccard join of word shingles, size-aware and heavy-light.

A document's set holds its distinct five-word shingles; two documents link at Jaccard similarity 0.75 or more. Equal
sets form one class first, so copies never meet each other. Elements have one global order in which frequent ones come
last. Two linked sets share an element among the first quarter of each (and the first seventh of the smaller one);
they share two among one element more.

* Small sets (light) list all subsets of two elements of that prefix; small sets meet in equal subsets.
* Large sets (heavy) are filed in inverted lists, one per element of the prefix, which are scanned for partners; small
  sets near the boundary are filed too, to meet large ones.
* The boundary is the largest size at which listing subsets costs no more than filing and scanning.

Lists are never turned into all their pairs. The lead of a list is its most typical member, the one whose elements are
in the largest lists on average; in a group of copies that is the text with the fewest edits. First each class is
compared with the lead it shares the most lists with; the links found join classes to components. Then only members of
one list that are still in different components are paired, and only where the places of the shared element in both
orders leave room for the threshold: of two sets with n and m elements that share their i-th and j-th, no more than
min(i, j) + min(n - i, m - j) can be shared. Copies of one text that are too far from it to link, and from each other,
would still meet in all pairs; two sets near the same lead are paired only if they share an element that the lead has
not, or if one lacks so many of the lead's that this needn't be. Nothing that could still link two components is left
out, so components are exact. Texts are read again only for classes that are compared.

Null and empty texts have no shingle and link with nothing; an empty table gives no rows. Repeated rows are copies. A
null id takes part; the component id is the smallest id that is not null. Texts of any length are taken whole. Ties for
a lead go to the larger set hash; no result depends on them. Only the id and the text are read; ``keep_one`` passes all
columns on, whatever their names. Rows, shingles and sets are told apart by 64-bit hashes. Intermediate tables are
deleted as soon as their last reader is done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tripweave.llm.common import Scratch, mix64, table, text_shingles, with_hint
from tripweave.llm.links import components

SIZE = 5
COUNT_CHUNK = 1 << 21  # shingles of a task looked through together for frequent ones
FREQUENT = 200_000  # elements that are moved to the end of the order at most; they are broadcast
SCAN_COST = 4.0  # of comparing with one member of a list, against writing one list entry
REMEMBERED = 50_000  # sets of which a task knows that it has filed them
PROMISING = 0.15  # part of a prefix that the first pairs share at least
GROUP = 512  # pairs with one class that are compared in one go
NULL_ID = -(1 << 63)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each text, ascending."""
    for shingles in text_shingles(texts, SIZE):
        own = np.sort(shingles)
        yield own[np.flatnonzero(np.diff(own, prepend=~own[:1]))] if len(own) else own


def prefix_size(n: int) -> int:
    """How many first elements of a set hold one that it shares with any linked partner."""
    return n // 4 + 1


def boundary(list_length: float) -> int:
    """Largest size whose subsets of two cost no more than list entries that meet ``list_length`` members each."""
    n = 3
    while (p := prefix_size(n + 1)) * (p + 1) / 2 <= p * (1 + SCAN_COST * list_length):
        n += 1
    return n


def _distinct_sets(texts: Iterator[pa.Array]) -> Iterator[np.ndarray]:
    """The shingle sets of a task's texts; a set that the task remembers is left out."""
    seen = set()
    for part in texts:
        for own in shingle_sets(part):
            mark = xxh3_64_intdigest(own.tobytes())
            if mark in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(mark)
            yield own


def frequent_elements(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """Elements that repeat, how many sets have them, and the mean number of others that repeat with one.

    All documents are read, twice. First each task looks for elements that repeat among ``COUNT_CHUNK`` shingles or
    more; the most frequent of these by the sum over all tasks are chosen. Then the chosen ones are counted in every
    document. Copies of a text that a task remembers count once, as they are filed once. The order of elements decides
    how much work is done, never what is found.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, total = [], 0, 0

        def drain():
            e, n = np.unique(np.concatenate(held) if held else np.empty(0, np.uint64), return_counts=True)
            many = n > 1
            return pa.RecordBatch.from_pydict({"e": pa.array(e[many].view(np.int64)), "n": pa.array(n[many].astype(np.int64))})

        for own in _distinct_sets(batch.column(0) for batch in batches):
            held.append(own)
            size += len(own)
            total += len(own)
            if size >= COUNT_CHUNK:
                yield drain()
                held, size = [], 0
        yield drain()
        # The element 0 stands for the number of all.
        yield pa.RecordBatch.from_pydict({"e": pa.array([0], pa.int64()), "n": pa.array([total], pa.int64())})

    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "frequent")
    texts = docs.select(text)
    found = scratch.stored(texts.mapInArrow(look, "e long, n long").groupBy("e").agg(F.sum("n").alias("n")), "found")
    top = found.filter("e <> 0").orderBy(F.desc("n"), "e").limit(FREQUENT).toArrow()
    least = int(top["n"].to_numpy().min()) if top.num_rows else 0
    sums = found.agg(
        F.sum(F.when(F.col("e") == 0, F.col("n"))).alias("all"),
        F.sum(F.when((F.col("e") != 0) & (F.col("n") < least), F.col("n") * F.col("n"))).alias("rest"),
    ).first()
    scratch.drop("found")
    list_length = 1.0 + float(sums["rest"] or 0) / max(1, sums["all"] or 0)
    chosen = np.sort(top["e"].to_numpy().view(np.uint64))
    if not len(chosen):
        return chosen, np.empty(0, np.int64), list_length
    shared = spark.sparkContext.broadcast(chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        times = np.zeros(len(known), np.int64)
        for own in _distinct_sets(batch.column(0) for batch in batches):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            # No element is twice in a set.
            times[at[known[at] == own]] += 1
        here = np.flatnonzero(times)
        yield pa.RecordBatch.from_pydict({"e": pa.array(known[here].view(np.int64)), "n": pa.array(times[here])})

    counts = scratch.stored(texts.mapInArrow(count, "e long, n long").groupBy("e").agg(F.sum("n").alias("n")), "counts").toArrow()
    scratch.drop("counts")
    shared.unpersist()
    frequent, times = counts["e"].to_numpy().view(np.uint64), counts["n"].to_numpy()
    by_hash = np.argsort(frequent)
    return frequent[by_hash], times[by_hash], list_length


def row_key(id_column: str, text: str) -> Column:
    """Hash of a row's id and text, by which it is found again; equal rows have equal ones."""
    return F.xxhash64(F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)), F.col(text))


def file_sets(docs: DataFrame, frequent: np.ndarray, times: np.ndarray, small: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, id, n, c, singles, subsets, places)`` of every document.

    ``c`` is the hash of the set. ``singles`` are the elements it is filed under, in order; ``subsets`` are hashes of
    two elements, and ``places`` says where in the order the second of them is. A set that the task has filed already
    has none of them.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, times))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (late, often), seen = shared.value, set()
        none = np.empty(0, np.uint64)
        for batch in batches:
            sizes, marks, lists = [], [], ([], [], [])
            for own in shingle_sets(batch.column(2)):
                n, mark = len(own), xxh3_64_intdigest(own.tobytes())
                singles, subsets, places = none, none, none
                if n >= 3 and mark not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(mark)
                    ranked = own
                    if len(late):
                        at = np.minimum(np.searchsorted(late, own), len(late) - 1)
                        # Rare elements first, then by how often they occur; by their hash among equals.
                        ranked = own[np.argsort(np.where(late[at] == own, often[at], 0), kind="stable")]
                    p = prefix_size(n)
                    if 4 * n >= 3 * (small + 1):
                        singles = ranked[:p]
                    if n <= small:
                        a, b = np.triu_indices(min(n, p + 1), 1)
                        subsets, places = mix64(ranked[a] * np.uint64(0x9E3779B97F4A7C15) + mix64(ranked[b])), (b + 1).astype(np.uint64)
                sizes.append(n)
                marks.append(mark)
                for out, value in zip(lists, (singles, subsets, places)):
                    out.append(value.view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "key": batch.column(0), "id": batch.column(1), "n": pa.array(sizes, pa.int32()), "c": pa.array(np.array(marks, np.uint64).view(np.int64)),
                "singles": pa.array(lists[0], pa.list_(pa.int64())), "subsets": pa.array(lists[1], pa.list_(pa.int64())),
                "places": pa.array(lists[2], pa.list_(pa.int64())),
            })

    filed = docs.select(
        row_key(id_column, text).alias("key"), F.coalesce(F.col(id_column).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text)
    )
    schema = "key long, id long, n int, c long, singles array<long>, subsets array<long>, places array<long>"
    return filed.mapInArrow(file, schema)


def entries(filed: DataFrame) -> DataFrame:
    """List entries ``(e, c, meta)``: classes under the elements, or subsets of two, of their prefixes.

    ``meta`` holds the size of the set in its upper half, then the place of the (second) element in the set's order,
    and in the last bit whether ``e`` is a subset; narrow rows keep the shuffle small.
    """
    one = filed.select("c", "n", F.posexplode("singles").alias("at", "e"))
    two = filed.select("c", "n", F.explode(F.arrays_zip("subsets", "places")).alias("s"))
    meta = lambda place, kind: F.col("n").cast("long") * (1 << 32) + 2 * place + kind
    return one.select("e", "c", meta(F.col("at") + 1, 0).alias("meta")).unionByName(
        two.select(F.col("s.subsets").alias("e"), "c", meta(F.col("s.places"), 1).alias("meta"))
    )


def shared_entries(filed: DataFrame) -> DataFrame:
    """Entries ``(e, c, n, at, two, members)`` of lists with more than one class; each once.

    Entries are dealt by their list once; most lists have one class and end there. ``members`` counts an entry for each
    task that filed it.
    """
    own = Window.partitionBy("e")
    lists = entries(filed).select(
        "e", "c", "meta", F.min("c").over(own).alias("lo"), F.max("c").over(own).alias("hi"), F.count("*").over(own).alias("members")
    )
    return lists.filter("lo <> hi").select("e", "c", "meta", "members").distinct().select(
        "e", "c", F.shiftright("meta", 32).cast("int").alias("n"),
        F.shiftright(F.col("meta").bitwiseAND(0xFFFFFFFF), 1).cast("int").alias("at"),
        (F.col("meta").bitwiseAND(1) == 1).alias("two"), "members",
    )


def with_leads(shared: DataFrame) -> DataFrame:
    """Append ``lead``: the most typical member of the list, by the mean size of the lists of its prefix."""
    typical = shared.groupBy("c").agg((F.sum("members") / F.max(F.col("n") / 4 + 1)).alias("typical"))
    best = F.max(F.struct("typical", "c")).over(Window.partitionBy("e"))
    return shared.join(typical, "c").withColumn("lead", best["c"]).drop("typical")


def _fits(a: str, b: str):
    return 4 * F.least(F.col(a), F.col(b)) >= 3 * F.greatest(F.col(a), F.col(b))


def first_pairs(shared: DataFrame) -> DataFrame:
    """Each class with the lead it shares most lists with, if those are a fair part of its prefix.

    Linked sets share three sevenths of their prefixes at least, but not all of their lists have the same lead. Pairs
    that are left out here are looked at again by :func:`further_pairs`.
    """
    met = shared.filter("c <> lead").groupBy("c", "lead").agg(F.count("*").alias("lists"), F.max("n").alias("n"))
    best = met.filter(F.col("lists") >= PROMISING * F.col("n") / 4).groupBy("c").agg(F.max(F.struct("lists", "lead")).alias("best"))
    return best.select(F.col("c").alias("a"), F.col("best.lead").alias("b"))


def _near_lead(first: DataFrame) -> DataFrame:
    """``(c, lead, missing, extra, others)``: classes that differ from their lead in fewer elements than it has.

    ``missing`` counts the lead's elements that the class lacks, ``others`` are the ones only the class has.
    """
    missing, extra = F.col("n_b") - F.col("both"), F.col("n_a") - F.col("both")
    return first.filter(missing + extra <= F.col("n_b")).select(
        F.col("a").alias("c"), F.col("b").alias("lead"), missing.alias("missing"), extra.alias("extra"),
        F.col("n_b").alias("n_lead"), F.col("n_a").alias("n"), "others",
    )


def pairs_by_extras(near: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` near one lead, in different components, that share enough elements the lead has not.

    Of x and y near a lead of k elements, the shared ones are at most k - max(missing) plus the shared extra ones.
    """
    rows = near.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c")).withColumn("x", F.explode("others"))
    names = ["c", "n", "missing", "root"]
    a = rows.select("lead", "x", "n_lead", *[F.col(v).alias(f"{v}_a") for v in names])
    b = rows.select("lead", "x", *[F.col(v).alias(f"{v}_b") for v in names])
    met = a.join(b, ["lead", "x"]).filter("c_a < c_b and root_a <> root_b").groupBy("c_a", "c_b").agg(
        F.count("*").alias("shared"), *[F.first(v).alias(v) for v in ("n_lead", "n_a", "n_b", "missing_a", "missing_b")]
    )
    most = F.col("n_lead") - F.greatest("missing_a", "missing_b") + F.col("shared")
    able = 7 * most >= 3 * (F.col("n_a") + F.col("n_b"))
    turned = F.col("n_a") > F.col("n_b")
    return met.filter(able).select(
        F.when(turned, F.col("c_b")).otherwise(F.col("c_a")).alias("a"), F.when(turned, F.col("c_a")).otherwise(F.col("c_b")).alias("b")
    )


def further_pairs(shared: DataFrame, found: DataFrame, first: DataFrame, small: int) -> DataFrame:
    """Pairs of classes of one list that are still in different components and may reach the threshold."""
    roots = found.withColumnRenamed("node", "c")
    near = _near_lead(first)
    # Without shared extra elements, two sets near one lead of k elements can link only if, for both orders,
    # 4 missing + 3 extra - k of one is at most 3 (missing - extra) of the other.
    gaps = near.select(
        "c", "lead", (4 * F.col("missing") + 3 * F.col("extra") - F.col("n_lead")).alias("far"),
        (3 * (F.col("missing") - F.col("extra"))).alias("short"),
    )
    labelled = shared.join(roots, "c", "left").join(gaps, "c", "left").select(
        "e", "c", "n", "at", "two", F.coalesce("root", "c").alias("root"), "lead", "far", "short"
    )
    # Lists that hold several components; both sides of the join read them from one shuffle.
    own = Window.partitionBy("e")
    rows = labelled.withColumns({"lo": F.min("root").over(own), "hi": F.max("root").over(own)}).filter("lo <> hi")
    # The smaller set (at equal size the lesser class) stands left. Of a subset the first place is within its first
    # seventh; of single elements all are met, to be counted.
    early = ~F.col("two") | (F.col("at") <= F.floor(F.col("n") / 7) + 2)
    names = ["c", "n", "at", "root", "lead", "far", "short"]
    a = rows.filter(early).select("e", "two", *[F.col(x).alias(f"{x}_a") for x in names])
    b = rows.select("e", *[F.col(x).alias(f"{x}_b") for x in ["two", *names]])
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("c_a") < F.col("c_b")))
    most = F.least("at_a", "at_b") + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    able = 7 * most >= 3 * (F.col("n_a") + F.col("n_b"))
    one_lead = F.coalesce(F.col("lead_a") == F.col("lead_b"), F.lit(False))
    lacking = (F.col("far_a") <= F.col("short_b")) & (F.col("far_b") <= F.col("short_a"))
    # The same columns on both sides, joined by the list alone, so that the shuffle is the same.
    met = a.join(b, "e").filter((~F.col("two") | F.col("two_b")) & 
        smaller & (F.col("root_a") != F.col("root_b")) & _fits("n_a", "n_b") & able & (~one_lead | lacking)
        & (F.col("two") | (F.col("n_b") > small))
    )
    # Of two linked sets with o shared elements at least, the one whose prefix ends first has all but n - o of its
    # prefix in the other's. Subsets of two are not counted; sharing one is enough.
    least = F.expr("cast(ceil(3 * (n_a + n_b) / 7.0) as int)")
    needed = F.least(*[F.floor(F.col(f"n_{x}") / 4) + 1 - (F.col(f"n_{x}") - least) for x in "ab"])
    by_lists = met.groupBy("c_a", "c_b", "n_a", "n_b").agg(F.max("two").alias("two"), F.count("*").alias("common"))
    by_lists = by_lists.filter(F.col("two") | (F.col("common") >= needed)).select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    pairs = by_lists.unionByName(pairs_by_extras(near, roots)).distinct()
    # Both orders of a pair that was compared already.
    tried = first.select("a", "b").unionByName(first.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(tried, ["a", "b"], "left_anti")


def asked_texts(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``(key, b, part, is_lead, c)``: which rows' texts are wanted for the pairs ``(a, b)``, and where.

    Each ``b`` is a group: its own text, then that of every ``a``. A group of more than ``GROUP`` pairs is cut into
    parts, each with the text of ``b``. A class is read by one of its rows, if possible one that occurs once.
    """
    parts = pairs.groupBy("b").agg(F.expr(f"cast((count(*) - 1) div {GROUP} as int)").alias("last"))
    leads = parts.select("b", F.explode(F.sequence(F.lit(0), "last")).alias("part"), F.lit(True).alias("is_lead"), F.col("b").alias("c"))
    members = pairs.select("a", "b").join(parts, "b").select(
        "b", F.pmod(F.xxhash64("a"), F.col("last") + 1).cast("int").alias("part"), F.lit(False).alias("is_lead"), F.col("a").alias("c")
    )
    asked = leads.unionByName(members)
    times = rows.select("c", "key").join(asked.select("c").distinct(), "c", "left_semi").groupBy("c", "key").count()
    chosen = times.groupBy("c").agg(F.min(F.struct("count", "key"))["key"].alias("key"))
    return asked.join(chosen, "c").select("key", "b", "part", "is_lead", "c")


def compared(scratch: Scratch, name: str, pairs: DataFrame, rows: DataFrame, docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``(a, b, n_a, n_b, both, others)``: sizes, shared elements and those that only ``a`` has, counted exactly.

    ``others`` is left out for sets that have little in common. Texts travel instead of sets of hashes, which are
    twice as large. A bitmap of bounded size keeps the texts that may be wanted, so that few of them are shuffled;
    copies are put together before.
    """
    kinds = pa.list_(pa.int64())

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lead = None, None
        for batch in batches:
            out: list[tuple] = []
            plain = [batch.column(k).to_pylist() for k in range(4)]
            for b, part, is_lead, c, own in zip(*plain, shingle_sets(batch.column(4))):
                # The text of another class, whose row has the same hash, counts for nothing.
                if np.uint64(xxh3_64_intdigest(own.tobytes())).view(np.int64).item() != c:
                    continue
                if is_lead:
                    group, lead = (b, part), own
                elif group == (b, part):
                    is_shared = lead[np.minimum(np.searchsorted(lead, own), len(lead) - 1)] == own
                    both = int(is_shared.sum())
                    near = len(own) - both + len(lead) - both <= len(lead)
                    out.append((c, b, len(own), len(lead), both, own[~is_shared].view(np.int64) if near else None))
            a, b, n_a, n_b, both, others = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n_a": pa.array(n_a, pa.int32()),
                "n_b": pa.array(n_b, pa.int32()), "both": pa.array(both, pa.int32()), "others": pa.array(others, kinds),
            })

    asked = scratch.stored(asked_texts(pairs, rows), f"asked-{name}")
    texts = docs.select(row_key(id_column, text).alias("key"), F.col(text).alias("text"))
    near = with_hint(texts, "key", asked.select("key")).filter("maybe").groupBy("key").agg(F.any_value("text").alias("text"))
    dealt = near.join(asked, "key").select("b", "part", "is_lead", "c", "text").repartition("b", "part")
    met = dealt.sortWithinPartitions("b", "part", F.desc("is_lead")).mapInArrow(
        against, "a long, b long, n_a int, n_b int, both int, others array<long>"
    )
    found = scratch.stored(met, f"compared-{name}")
    scratch.drop(f"asked-{name}")
    return found


def links_of(pairs: DataFrame) -> DataFrame:
    """The compared pairs that reach the threshold, as ``(u, v)``."""
    linked = 100 * F.col("both") >= 75 * (F.col("n_a") + F.col("n_b") - F.col("both"))
    return pairs.filter(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))


def classified(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, id, n, c, root)`` of every document: its key, its class, and the class that stands for its component."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    frequent, times, list_length = frequent_elements(docs, text)
    small = boundary(list_length)
    filed = scratch.stored(file_sets(docs, frequent, times, small, id_column, text), "filed")
    rows = scratch.stored(filed.select("key", "id", "n", "c"), "rows")
    shared = scratch.stored(shared_entries(filed), "shared")
    scratch.drop("filed")
    first = compared(scratch, "first", scratch.stored(first_pairs(with_leads(shared)), "pairs"), rows, docs, id_column, text)
    found = components(links_of(first))
    rest = scratch.stored(further_pairs(shared, found, first, small), "further")
    scratch.drop("shared", "pairs")
    second = compared(scratch, "second", rest, rows, docs, id_column, text)
    found = components(links_of(first).unionByName(links_of(second)))
    out = scratch.stored(
        rows.join(found.withColumnRenamed("node", "c"), "c", "left").select("key", "id", "n", "c", F.coalesce("root", "c").alias("root")),
        "classified",
    )
    scratch.drop("rows", "further", "compared-first", "compared-second")
    return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` of every document."""
    rows = classified(docs, id_column, text)
    real = F.when(F.col("id") != NULL_ID, F.col("id"))
    # Copies are summed up before the shuffle, so a component of any size is a few rows of each task. Stored, as the
    # rows of a large component are split over tasks only if nothing else stands between shuffle and join.
    least = Scratch(docs.sparkSession, "jaccard").stored(
        rows.filter("n > 0").groupBy("root").agg(F.min(real).alias("component_id")), "least"
    )
    return rows.join(least, "root", "left").select(
        real.alias(id_column), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(real).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with its own columns: that with the smallest id (null last), then text's hash.

    Rows are judged one by one, by their id and text together, so another text under the same id is not touched. Of
    equal rows one stays. Texts without a shingle are linked with nothing and all stay.
    """
    rows = classified(docs.select("doc_id", "text")).filter("n > 0")
    scratch = Scratch(docs.sparkSession, "keep-one")
    best = F.min(F.struct((F.col("id") == NULL_ID).alias("nameless"), "id", "key"))["key"]
    kept = scratch.stored(rows.groupBy("root").agg(best.alias("kept")), "kept")
    each = rows.groupBy("root", "key").agg(F.count("*").alias("times")).join(kept, "root")
    # Rows to look at: those to drop, and those to keep of which there are several.
    open_ = scratch.stored(
        each.filter("key <> kept or times > 1").groupBy(F.col("key").alias("_open")).agg(F.max(F.col("key") == F.col("kept")).alias("_stays")),
        "open",
    )
    hinted = with_hint(docs.withColumn("_key", row_key("doc_id", "text")), "_key", open_.select("_open"), "_maybe")
    met = hinted.filter("_maybe").join(open_, F.col("_key") == F.col("_open"), "left")
    free = hinted.filter("not _maybe").select(*docs.columns).unionByName(met.filter("_open is null").select(*docs.columns))
    again = met.filter("_stays").groupBy("_key").agg(F.any_value(F.struct(*docs.columns)).alias("_row"))
    return free.unionByName(again.select("_row.*"))


def op9_jaccard_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
