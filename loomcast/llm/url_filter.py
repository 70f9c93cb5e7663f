"""URL filter: a blocked Bloom filter passes possible hits to an exact hash join.

The listed URLs are canonical: a host, a path prefix and a verdict. A page's
candidate keys are its host and parent hosts, each with the path prefixes whose
lengths occur in the list. Keys that the filter passes are joined with the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path, verdict): fixed values of the contract.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Most 64-bit blocks of the filter: 2 MB, whatever the list's size.
MOST_BLOCKS = 1 << 18


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Lower-cased host and path; both empty for null or a url without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _mask(key: Column) -> Column:
    """Three bits of the 64 of a block."""
    bits, out = F.xxhash64(key, F.lit(2)), None
    for shift in (0, 8, 16):
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(bits, shift).bitwiseAND(63).cast("int"))
        out = one if out is None else out.bitwiseOR(one)
    return out


def bloom(rules: DataFrame) -> tuple[DataFrame, int]:
    """One row with ``words``, the filter's blocks as an array, and their number.

    About 32 bits a rule up to ``MOST_BLOCKS``; beyond that the filter passes
    more false positives, which the join removes.
    """
    blocks = max(16, min(MOST_BLOCKS, rules.count() // 2 + 1))
    key = F.concat("host", "path")
    words = rules.groupBy(_block(key, blocks).alias("block")).agg(F.bit_or(_mask(key)).alias("word"))
    filled = F.map_from_entries(F.collect_list(F.struct("block", "word")))
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    one = words.agg(filled.alias("filled")).select(
        F.transform(every, lambda b: F.coalesce(F.try_element_at("filled", b), F.lit(0).cast("long"))).alias("words")
    )
    return one, blocks


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains where the path starts with the
    rule's; the longest rule wins (of equal length the longer host, then the
    smaller text; of equal rules the smaller verdict). Pages that no rule fits
    get ``default``. Null urls, null ids, repeated rows, an empty list and other
    columns are fine.
    """
    rules = (
        rules.filter("host is not null and path is not null")
        .groupBy("host", "path")
        .agg(F.min("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
    )
    host, path = host_and_path()
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    page = page.withColumn("row", F.monotonically_increasing_id())
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().orderBy(F.length("path")).collect()]
    words, blocks = bloom(rules)
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    keys = F.flatten(
        F.transform(
            suffixes,
            lambda h: F.transform(
                F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.struct(h.alias("host"), p.alias("path"))
            ),
        )
    )
    word = words.scalar()
    possible = F.filter(
        keys,
        lambda k: F.element_at(F.col("words"), (_block(F.concat(k["host"], k["path"]), blocks) + 1).cast("int"))
        .bitwiseAND(_mask(F.concat(k["host"], k["path"])))
        == _mask(F.concat(k["host"], k["path"])),
    )
    if not lengths:
        null = F.lit(None).cast("string")
        return page.select("page_id", "host", "path", null.alias("rule"), F.lit(default).alias("verdict"))
    seen = page.withColumn("words", word).withColumn("keys", possible).drop("words")
    hits = seen.select("*", F.explode_outer("keys").alias("key")).select(
        "row", "page_id", "host", "path", F.col("key.host").alias("rule_host"), F.col("key.path").alias("rule_path")
    )
    listed = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "rule", "verdict")
    joined = hits.join(listed, ["rule_host", "rule_path"], "left")
    rank = F.when(
        F.col("rule").isNotNull(),
        F.struct(F.length("rule").alias("a"), F.length("rule_host").alias("b"), F.col("rule").alias("c")),
    )
    best = joined.groupBy("row", "page_id", "host", "path").agg(
        F.max_by(F.struct("rule", "verdict"), rank).alias("best")
    )
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
