"""Customer search without reading all customers: posting lists of three-letter pieces.

Every name, email, phone and hex id is cut into its pieces of three code points, lower-cased; a posting is a piece and
a customer. A text that contains a term contains all its pieces, so customers who have them all are the only ones to
look at; the search's own conditions then decide. In a pattern for names (``%`` and ``_`` are live) the parts between
live characters have to be contained. A term, or a pattern without a part, of under three characters has no piece and is searched without the
index.

Postings are stored in folders by piece and sorted within, so a search reads the folders and row groups of its pieces.
If few customers are left, their rows are looked up by id, which the customer table has Bloom filters for; otherwise
they are joined.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.identity import hex_id

ID = "resolved_customer_id"
PIECE = 3
BUCKETS = 64
LOOKED_UP = 1_000  # customers that are looked up by id at most


def _pieces(text: str) -> set[str]:
    low = text.lower()
    return {low[k : k + PIECE] for k in range(len(low) - PIECE + 1)}


def bucket_of(column):
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


def postings(dim: DataFrame) -> DataFrame:
    """``(piece, resolved_customer_id, bucket)``, each once, dealt by bucket.

    A row's pieces are made distinct in place, and those of repeated ids after they are dealt, so postings are shuffled
    once.
    """
    lists = [F.coalesce(c, F.array().cast("array<string>")) for c in ("emails", "phones")]
    texts = F.filter(F.concat(F.array("name_std", hex_id(F.col(ID))), *lists), lambda x: F.length(x) >= PIECE)
    # Lower-casing can shorten a text; one that got too short has no piece.
    long = F.filter(F.transform(texts, F.lower), lambda x: F.length(x) >= PIECE)
    pieces = F.transform(
        long, lambda x: F.transform(F.sequence(F.lit(1), F.length(x) - (PIECE - 1)), lambda k: F.substr(x, k, F.lit(PIECE)))
    )
    rows = dim.select(ID, F.explode(F.array_distinct(F.flatten(pieces))).alias("piece"))
    return rows.select("piece", ID, bucket_of("piece").alias("bucket")).repartition("bucket").distinct()


def write_postings(dim: DataFrame, path: str) -> None:
    postings(dim).sortWithinPartitions("bucket", "piece", ID).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_postings(spark, path: str) -> DataFrame:
    return spark.read.schema(f"piece string, {ID} string, bucket int").parquet(path)


def alternatives(term: str) -> list[set[str]] | None:
    """Sets of pieces of which a customer has one whole set; None if the index cannot tell."""
    plain = _pieces(term)
    parts = set().union(*[_pieces(part) for part in re.split("[%_]", term)])
    return None if not plain or not parts else [plain] if plain == parts else [plain, parts]


def candidates(index: DataFrame, term: str) -> DataFrame | None:
    """Ids of customers who may match the term; None if all may."""
    sets = alternatives(term)
    if sets is None:
        return None
    pieces = sorted(set().union(*sets))
    spark = index.sparkSession
    listed = spark.createDataFrame([(p,) for p in pieces], "piece string").select("piece", bucket_of("piece").alias("bucket"))
    buckets = sorted({r["bucket"] for r in listed.collect()})
    met = index.filter(F.col("bucket").isin(buckets) & F.col("piece").isin(pieces))
    have = [F.count_if(F.col("piece").isin(sorted(s))) == len(s) for s in sets]
    flagged = met.groupBy(ID).agg(*[h.alias(f"set_{k}") for k, h in enumerate(have)])
    return flagged.filter(" or ".join(f"set_{k}" for k in range(len(sets)))).select(ID)


def reduced(dim: DataFrame, index: DataFrame, term: str) -> DataFrame:
    """The customers a search for the term has to look at."""
    found = candidates(index, term)
    if found is None:
        return dim
    ids = [r[ID] for r in found.limit(LOOKED_UP + 1).collect()]
    if len(ids) <= LOOKED_UP:
        return dim.filter(F.col(ID).isin(ids))
    return dim.join(found, ID, "left_semi")
