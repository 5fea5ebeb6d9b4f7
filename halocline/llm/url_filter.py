"""URL filter: a blocked Bloom filter of listed URLs, then an exact hash join.

A rule is an action (allow or block), a host and a path prefix. It fits its host and all
subdomains where the URL's path starts with the rule's path; of the rules that fit, the one with
the longest host wins, then the longest path.

Each distinct (host, path) is expanded to the keys that a rule could have: every suffix of
the host on label borders with every prefix of the path whose length some rule has. The
filter, one row for each block of 512 bits, drops nearly all keys that no rule has; an
exact join on the key removes the false positives that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

BLOCK_WORDS = 8  #: 64-bit words of a block
PROBES = 8  #: bits set in a block for each key, one a word


def canonical_host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty for null or no '://'."""
    host = F.regexp_extract(_after_scheme(url), r"\A([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical_path(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def _place(key: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    """The key's block, and its bit in each of the block's words."""
    h, g = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(g, 6 * i).bitwiseAND(F.lit(63))).cast("int")) for i in range(PROBES)]
    return F.pmod(h, F.lit(n_blocks)), bits


def bloom(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """A blocked Bloom filter as rows (block, w0 .. w7), n_blocks at most. Nulls are left out."""
    block, bits = _place(F.col(key), n_blocks)
    rows = keys.where(F.col(key).isNotNull()).select(block.alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(bits)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_WORDS)))


def maybe_listed(df: DataFrame, key: str, filter_rows: DataFrame, n_blocks: int, broadcast_blocks: int, inverse: bool = False) -> DataFrame:
    """Rows of df whose key the filter may hold, never losing a listed one; with inverse, all the other rows."""
    block, bits = _place(F.col(key), n_blocks)
    small = filter_rows.select(F.col("block").alias("_of"), *(F.col(f"w{i}").alias(f"_w{i}") for i in range(BLOCK_WORDS)))
    small = small if n_blocks > broadcast_blocks else F.broadcast(small)
    probe = df.withColumn("_block", block).join(small, F.col("_block") == F.col("_of"), "left" if inverse else "inner")
    hit = F.lit(True)
    for i, b in enumerate(bits):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(b) != 0)
    return probe.where(~F.coalesce(hit, F.lit(False)) if inverse else hit).select(*df.columns)


def judge(urls: DataFrame, url: str, rules: DataFrame, default: str = "allow", bits_per_rule: int = 24, broadcast_blocks: int = 1 << 16) -> DataFrame:
    """urls with host, path, rule and verdict.

    rules: action, host, path; a rule whose host is null or empty is left out, a null path is empty, and of equal
    (host, path) a block beats an allow. A url that no rule fits has a null rule and the verdict `default`.
    Repeated rows stay; columns of urls called host, path, rule or verdict are replaced. Null urls and urls without
    '://' have an empty host and path and fit no rule. Urls of any length are read whole. An empty table of urls gives no
    rows; without rules every url has the default.

    The filter is broadcast while it has at most broadcast_blocks blocks of 64 bytes (4 MB), and joined on the block
    beyond that. The rule and key joins are left to Spark, which measures their sizes.
    """
    clean = rules.where(F.coalesce(F.col("host"), F.lit("")) != "").select(F.lower("host").alias("_rh"), F.coalesce("path", F.lit("")).alias("_rp"), "action")
    clean = clean.groupBy("_rh", "_rp").agg(F.max("action").alias("_action")).withColumn("_rkey", _key(F.col("_rh"), F.col("_rp")))
    known = clean.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.length("_rp"))).alias("lengths")).first()
    n_blocks = 1 << max(0, (known["n"] * bits_per_rule // (64 * BLOCK_WORDS)).bit_length())
    lengths = F.array(*(F.lit(x) for x in known["lengths"])) if known["lengths"] else F.expr("cast(array() as array<int>)")

    own = urls.drop("host", "path", "rule", "verdict").withColumns({"host": canonical_host(F.col(url)), "path": canonical_path(F.col(url))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    # A path counts up to the longest rule's length only: far fewer distinct keys than urls.
    head = F.substring("path", 1, max([0, *known["lengths"]]))
    sites = own.select("host", head.alias("path")).where(F.col("host") != "").distinct()
    keys = sites.select("host", "path", F.explode(suffixes).alias("_h")).select("host", "path", "_h", F.explode(prefixes).alias("_p"))
    keys = keys.withColumn("_key", _key(F.col("_h"), F.col("_p")))
    hits = maybe_listed(keys, "_key", bloom(clean, "_rkey", n_blocks), n_blocks, broadcast_blocks)
    exact = hits.join(clean, hits["_key"] == clean["_rkey"])
    rank = F.struct(F.length("_rh"), F.length("_rp"))
    best = exact.groupBy(F.col("host").alias("_host"), F.col("path").alias("_path")).agg(F.max_by(F.struct(F.concat("_rh", "_rp").alias("rule"), "_action"), rank).alias("_best"))
    # Stored: as a plain table it is broadcast if it is small, and else a hot site's rows can be split among tasks.
    best = stored(best, "judged")
    return (
        own.withColumn("_head", head)
        .join(best, (F.col("host") == F.col("_host")) & (F.col("_head") == F.col("_path")), "left")
        .withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best._action"), F.lit(default))})
        .drop("_head", "_host", "_path", "_best")
    )


#: Fixed values of the query: action, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def query(spark, sf_dir: str) -> DataFrame:
    """Every row of pages under the fixed rules; see judge(). Repeated rows stay, further columns are left out."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    return judge(pages, "url", rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
with u as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r from pages),
p as (
  select page_id, translate(regexp_extract(coalesce(r, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) as path from u),
rules(action, rh, rp) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f as (
  select page_id, arg_max(struct_pack(rule := rh || rp, action := action), length(rh) * 1000000 + length(rp)) as b
  from p join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
select p.page_id, host, path, f.b.rule as rule, coalesce(f.b.action, 'allow') as verdict from p left join f on p.page_id = f.page_id
"""
