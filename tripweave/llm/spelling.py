"""Grouping of spelling variants by a trie of letter-group counts.

A word's path is its length and then how many of its code points fall into each of 16 groups (code point modulo 16), one
level after the other; words with one path are a leaf, together. One edit moves a path by little: an insertion adds one
to a single count, a deletion takes one away, a replacement does both or neither. So a depth-first search that may
spend one surplus and one deficit reaches the leaves of all words one edit away, and only their words are verified.

The trie is never in one place. Its top levels, the length and the first groups, name subtrees; a subtree is built in
the task that its name is dealt to, and each word is sent to the subtrees that its budget can reach. As being near is
mutual, a word looks for longer ones by a surplus alone and for equally long ones in its own subtree or later ones.
Subtrees get more levels to their names until none is above ``SUBTREE`` words. In a leaf of many words (rearrangements
of the same letters) a word meets only those that equal it with one place left out.

Words: maximal runs of ``[A-Za-z`` and U+00C0 to U+00FF``]``, with A-Z lower-cased. With h the CRC-32 of
``<doc_id>:<run>``, a run of which 199 divides h loses its code point h % length, a made slip of the pen. Distinct
results of at least 6 code points and 5 occurrences are the words. A word's form is its most frequent near word (the
first in code point order among equals) if that occurs at least 5 times as often; its root is where forms lead.

Null and empty texts have no words. A null id counts as an empty one in h. Repeated rows count each. Texts and words of
any length are taken whole. An empty table gives no rows. Only the id and the text are read, so further columns of any
name do not matter. Forms occur 5 times as often at each step, so chains of them are short and have no cycle.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import stored, table

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5  # how many times as often a form occurs
SLIP = 199
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")  # of text whose A-Z are lower-cased
GROUPS = 16
LEVELS = (5, 1, 9, 14, 4, 3, 2, 15, 12, 13, 0, 7, 6, 8, 10, 11)  # groups by the levels of the trie, vowels first
NAMED = 5  # groups in the name of a subtree, at first
SUBTREE = 200_000  # words that a subtree holds at most, unless all levels are used up
CROWD = 4  # words of a leaf that are verified one by one
HELD = 200_000  # words that a task counts before it hands them on


def counted_words(docs: DataFrame, id_column: str = "doc_id", text: str = "text", slip: int = SLIP) -> DataFrame:
    """``(word, n)`` over all documents, of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def drain() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if not raw:
                    continue
                start = crc32(f"{doc_id}:".encode())
                for run, n in Counter(RUN.findall(raw.lower().decode("utf-8", "replace"))).items():
                    h = crc32(run.encode(), start)
                    if h % slip == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < LEAST_LENGTH:
                            continue
                    held[run] += n
                if len(held) >= HELD:
                    yield drain()
                    held.clear()
        yield drain()

    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text))
    parts = rows.mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def path_of(word: str) -> list[int]:
    """The length, then the counts of the letter groups in the order of the levels."""
    counts = [0] * GROUPS
    for c in word:
        counts[ord(c) % GROUPS] += 1
    return [len(word), *[counts[g] for g in LEVELS]]


def name_of(path: list[int], named: int) -> str:
    return ".".join(map(str, path[: named + 1]))


def reachable(path: list[int], named: int) -> Iterator[tuple[str, bool]]:
    """Names of the subtrees to search, and whether for words longer by one."""
    own = path[: named + 1]

    def moved(*steps: tuple[int, int]) -> list[int]:
        out = list(own)
        for level, step in steps:
            out[level] += step
        return out

    levels = range(1, named + 1)
    yield name_of(moved((0, 1)), named), True
    for i in levels:
        yield name_of(moved((0, 1), (i, 1)), named), True
    yield name_of(own, named), False
    # Later in the order of paths: the first count that differs is the larger one.
    for i in levels:
        yield name_of(moved((i, 1)), named), False
        for j in range(i + 1, named + 1):
            if own[j]:
                yield name_of(moved((i, 1), (j, -1)), named), False


def one_edit(short: str, long: str) -> bool:
    """Whether one inserted or replaced code point makes the first word the second, which is no shorter."""
    if short == long:
        return False
    at = next((k for k, (a, b) in enumerate(zip(short, long)) if a != b), len(short))
    return short[at + (len(short) == len(long)) :] == long[at + 1 :]


class Leaf:
    """Words with one path."""

    __slots__ = ("words", "gaps")

    def __init__(self):
        self.words: list[tuple[str, int]] = []
        self.gaps: dict | None = None

    def near(self, word: str, longer: bool) -> list[tuple[str, int]]:
        """The words that one insertion (``longer``) or one replacement makes of ``word``."""
        if len(self.words) <= CROWD:
            return [w for w in self.words if one_edit(word, w[0])]
        if self.gaps is None:
            self.gaps = defaultdict(list)
            for w in self.words:
                for k in range(len(w[0])):
                    self.gaps[k, hash(w[0][:k] + w[0][k + 1 :])].append(w)
        whole = hash(word)
        places = ((k, whole) for k in range(len(word) + 1)) if longer else ((k, hash(word[:k] + word[k + 1 :])) for k in range(len(word)))
        met = {w for place in places for w in self.gaps.get(place, ())}
        return [w for w in met if one_edit(word, w[0])]


class Trie:
    """Nested maps from counts to what follows, down to leaves."""

    def __init__(self):
        self.root: dict = {}

    def add(self, path: list[int], word: str, n: int) -> None:
        node = self.root
        for count in path[:-1]:
            node = node.setdefault(count, {})
        node.setdefault(path[-1], Leaf()).words.append((word, n))

    def leaves(self, path: list[int], longer: bool) -> Iterator[Leaf]:
        """Leaves of the length asked for that one surplus, and one deficit if not ``longer``, lead to."""
        top = self.root.get(path[0] + longer)
        stack = [(top, 1, 1, 0 if longer else 1)] if top is not None else []
        while stack:
            node, level, surplus, deficit = stack.pop()
            if level == len(path):
                yield node
                continue
            want = path[level]
            for step, up, down in ((0, surplus, deficit), (1, surplus - 1, deficit), (-1, surplus, deficit - 1)):
                if up >= 0 and down >= 0 and (child := node.get(want + step)) is not None:
                    stack.append((child, level + 1, up, down))


def routed(words: DataFrame, named: int) -> DataFrame:
    """``(tree, asks, longer, word, n)``: each word at home in its subtree, and as a question in those it can reach."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word, n in zip(*[c.to_pylist() for c in batch.columns]):
                path = path_of(word)
                out.append((name_of(path, named), False, False, word, n))
                out += [(tree, True, longer, word, n) for tree, longer in reachable(path, named)]
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.string(), pa.bool_(), pa.bool_(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "asks", "longer", "word", "n"])

    return words.select("word", "n").mapInArrow(send, "tree string, asks boolean, longer boolean, word string, n long")


def near_words(words: DataFrame, named: int = NAMED) -> DataFrame:
    """``(word, near, near_n)``: both directions of each pair of words that are one edit apart."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, trie = None, Trie()
        for batch in batches:
            out: list[tuple[str, str, int]] = []
            for tree, asks, longer, word, n in zip(*[c.to_pylist() for c in batch.columns]):
                if tree != name:
                    name, trie = tree, Trie()
                path = path_of(word)
                if not asks:
                    trie.add(path, word, n)
                    continue
                at_home = not longer and tree == name_of(path, named)
                for leaf in trie.leaves(path, longer):
                    for other, m in leaf.near(word, longer):
                        if not at_home or word < other:
                            out += [(word, other, m), (other, word, n)]
            a, b, m = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_pydict({"word": pa.array(a, pa.string()), "near": pa.array(b, pa.string()), "near_n": pa.array(m, pa.int64())})

    dealt = routed(words, named).repartition("tree").sortWithinPartitions("tree", "asks")
    return dealt.mapInArrow(search, "word string, near string, near_n long")


def levels_for(words: DataFrame, most: int = SUBTREE) -> int:
    """How many groups a subtree's name needs for none to hold more than ``most`` words."""

    @F.arrow_udf("string")
    def name(named: pa.Array, word: pa.Array) -> pa.Array:
        return pa.array([name_of(path_of(w), k) for k, w in zip(named.to_pylist(), word.to_pylist())], pa.string())

    named = NAMED
    while named < GROUPS:
        largest = words.groupBy(name(F.lit(named), "word").alias("tree")).count().agg(F.max("count")).first()[0]
        if not largest or largest <= most:
            break
        named += 2
    return min(named, GROUPS)


def with_roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: the end of each chain of forms, in rounds that double the reach."""
    reach = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(reach.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reach = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return reach


def variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", slip: int = SLIP) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word."""
    words = stored(counted_words(docs, id_column, text, slip), "words")
    pairs = near_words(words, levels_for(words))
    # Most frequent first, then the first in code point order, which is that of UTF-8 bytes.
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("turned"), "near")).alias("best"))
    is_form = -F.col("best.turned") >= RATIO * F.col("n")
    judged = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.turned")).alias("form_n"),
        ),
        "judged-words",
    )
    roots = with_roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
with recursive texts as (
    select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), tokens as (
    select doc_id, unnest(regexp_extract_all(t, '[a-z\x{C0}-\x{FF}]+')) as run from texts
), runs as (
    select doc_id, run, count(*) as n from tokens where length(run) >= 6 group by 1, 2
), bits as (
    -- CRC-32 bit by bit: each byte of the text stands first among eight steps.
    select *, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), lambda c:
        case when unicode(c) < 128 then [unicode(c)::bigint, 0, 0, 0, 0, 0, 0, 0]
        else [192 + unicode(c)::bigint // 64, 0, 0, 0, 0, 0, 0, 0, 128 + unicode(c)::bigint % 64, 0, 0, 0, 0, 0, 0, 0] end)) as b
    from runs
), hashed as (
    select run, n, xor(4294967295::bigint, list_reduce(b, lambda h, x:
        xor(xor(h, x) >> 1, (xor(h, x) & 1) * 3988292384::bigint), 4294967295::bigint)) as h
    from bits
), slipped as (
    select n, case when h % 199 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word
    from hashed
), words as (
    select word, sum(n)::bigint as n from slipped where length(word) >= 6 group by 1 having sum(n) >= 5
), gaps as (
    select word, n, length(word) as l, unnest(range(1, length(word) + 1)) as i from words
), shorter as (
    select word, n, l, i, left(word, i - 1) || substr(word, i + 1) as rest from gaps
), near as (
    select a.word, b.word as other, b.n as m from shorter a join shorter b on a.i = b.i and a.rest = b.rest and a.l = b.l and a.word <> b.word
    union select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
    union select b.word, a.word, a.n from shorter a join words b on a.rest = b.word
), best as (
    select word, count(*) as n_near, max(m) as m from near group by 1
), judged as (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.m >= 5 * w.n then b.m end as form_n,
        case when b.m >= 5 * w.n then (select min(encode(x.other)) from near x where x.word = w.word and x.m = b.m) end as raw
    from words w left join best b on w.word = b.word
), forms as (
    select word, n, n_near, form_n, decode(raw) as form from judged
), walk as (
    select word, word as at from forms
    union all select walk.word, forms.form from walk join forms on forms.word = walk.at where forms.form is not null
), ends as (
    select walk.word, walk.at as root from walk join forms on forms.word = walk.at where forms.form is null
)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n from forms f join ends e on e.word = f.word
"""
