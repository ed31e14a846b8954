"""URL filters by host-suffix and path-prefix expressions.

Every URL is expanded into expressions (suffix of its host's labels, prefix of its path up to a ``/``). Expressions
meet the rules in an equi-join on a short prefix of their SHA-256 digest; the full digest and the rest of the rule's
path are then confirmed, and the longest rule wins (at equal length ``block`` wins over ``allow``). Expansion goes no
deeper than the deepest rule, which loses nothing. Only different (host, path) pairs are expanded and joined.

A null URL, or one without ``://``, has an empty host and path and meets no rule, like any URL that no rule fits: the
default verdict holds. Repeated rows give repeated results; an empty table gives an empty one. No columns but the id
and the URL are read, so extra ones can't clash. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm.common import table

SHORT = 8  # hex digits of a digest that are joined on
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the registered query.
RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
    ("net/fr/", "block"),
]


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, most: int) -> Column:
    """The host's last 1, 2, ... labels, up to ``most``."""
    return F.transform(F.sequence(F.lit(1), F.least(F.size(F.split(host, r"\.")), F.lit(max(1, most)))), lambda k: F.call_function("substring_index", host, F.lit("."), -k))


def path_prefixes(path: Column, most: int) -> Column:
    """The empty prefix, and the path up to its 1st, 2nd, ... ``/``, up to ``most`` of them."""
    slashes = F.size(F.split(path, "/")) - 1
    return F.transform(
        F.sequence(F.lit(0), F.least(slashes, F.lit(most))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/"))),
    )


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules ``(rule, verdict)`` with host, path, the expression they are found by, and its digest."""
    at = F.locate("/", "rule")
    host = F.translate(F.when(at > 0, F.substr("rule", F.lit(1), at - 1)).otherwise(F.col("rule")), UPPER, LOWER)
    path = F.when(at > 0, F.substr("rule", at)).otherwise("")
    folder = F.regexp_extract(path, r"^(?s:.*)/", 0)
    return (
        rules.filter(F.col("rule").isNotNull() & (F.col("rule") != "")).select("rule", "verdict").distinct()
        .select("rule", "verdict", path.alias("rule_path"), F.size(F.split(host, r"\.")).alias("labels"),
                (F.size(F.split(folder, "/")) - 1).alias("slashes"), F.sha2(F.concat(host, folder), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row."""
    known = rule_table(rules)
    deepest = known.agg(F.max("labels"), F.max("slashes")).first()
    labels, slashes = deepest[0] or 1, deepest[1] or 0
    split = pages.select(F.col(id_column), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"))
    expressions = (
        split.select("host", "path").filter(F.col("host") != "").distinct()
        .withColumn("suffix", F.explode(host_suffixes(F.col("host"), labels)))
        .withColumn("prefix", F.explode(path_prefixes(F.col("path"), slashes)))
        .select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    found = (
        expressions.alias("u").join(known.alias("r"), F.col("u.short") == F.col("r.short"))
        .filter((F.col("u.digest") == F.col("r.digest")) & F.col("u.path").startswith(F.col("r.rule_path")))
        .groupBy(F.col("u.host").alias("host"), F.col("u.path").alias("path"))
        .agg(F.max(F.struct(F.char_length("r.rule").alias("length"), (F.col("r.verdict") == "block").alias("block"),
                            F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))).alias("best"))
    )
    return split.join(found, ["host", "path"], "left").select(
        id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def given_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "rule string, verdict string")


def op3_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"), given_rules(spark))


OP3_SQL = f"""
WITH rules(rule, verdict) AS (VALUES {", ".join(f"('{r}', '{v}')" for r, v in RULES)}),
parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM parts)
),
pairs AS (SELECT DISTINCT host, path FROM split),
fits AS (
  SELECT host, path, rule, verdict, row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC) AS nth
  FROM pairs JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/')))
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (host, path)
"""
