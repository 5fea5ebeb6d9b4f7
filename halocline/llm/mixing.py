"""Mixing sources to target weights by min-cost flow.

Documents may be in several sources. They are aggregated by membership pattern (the set of their sources), each with so
many words. Words flow from patterns to the quotas of their sources; the first pass over a pattern's documents costs
nothing, and each further one more than the one before, so documents are repeated only where nothing else fills a quota.
Patterns that share no source, directly or by others, are solved apart, each group in a task. Which documents make up a
pattern's share is told by a seeded hash of their ids.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import components
from .shared import stored, table

WEIGHTS = (3.0, 1.0, 2.0)  #: repeating, for the sources in order
SHARE = 1.5  #: of all words
REPEATS = 2  #: times that a document may be taken
SEED = 20
BUCKET = 4096  #: documents of a pattern in one hash bucket, about
WORD = "[^\\x20\\x09-\\x0D]+"


def _key(source: Column) -> Column:
    """A source as text that no other source has; null is one of its own."""
    return F.coalesce(F.concat(F.octet_length(source).cast("string"), F.lit(":"), source), F.lit("~"))


def sized(docs: DataFrame, sources: Column, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, size, sources, pattern, h), stored: words, distinct sources in order, their key, place in the seeded order."""
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    own = F.array_sort(F.array_distinct(sources))
    rows = docs.select(F.col(doc_id).alias("doc_id"), size.alias("size"), own.alias("sources"))
    pattern = F.array_join(F.transform("sources", _key), ",")
    return stored(rows.withColumn("pattern", pattern).withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id"))), "sized")


def patterns(rows: DataFrame) -> DataFrame:
    """(pattern, sources, capacity, n): stored. Rows fold before they are shuffled, so a hot source doesn't matter."""
    return stored(rows.groupBy("pattern", "sources").agg(F.sum("size").alias("capacity"), F.count("*").alias("n")), "patterns")


def ranked(found: DataFrame) -> DataFrame:
    """(source, key, source_size, rank): the sources by code point, null last, ranked from 0.

    Ranges of sources are ranked side by side; only the number of sources in each range is summed over all.
    """
    each = found.select(F.explode("sources").alias("source"), "capacity").groupBy("source").agg(F.sum("capacity").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    parts = stored(each.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    before = parts.groupBy("part").count()
    before = before.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))  # a row a range
    return parts.withColumn("own", own).join(before, "part").select("source", _key(F.col("source")).alias("key"), "source_size", (F.col("own") - 1 + F.col("before")).cast("long").alias("rank"))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """sources, stored, with `target`: share * all words by weight; none above repeats * its size, the excess reshared by weight.

    Each round is an aggregate: the level (words for a unit of weight) that fills the sources below their bound. It only
    rises, and ends when no further source reaches its bound.
    """
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    each = stored(sources.withColumn("weight", w).withColumn("bound", F.col("source_size") * F.lit(float(repeats))), "weighed")
    total = share * (each.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        at = F.col("bound") < F.lit(level) * F.col("weight")
        n, fixed, weight = each.agg(F.count_if(at), F.sum(F.when(at, F.col("bound")).otherwise(0.0)), F.sum(F.when(at, 0.0).otherwise(F.col("weight")))).first()
        if n == full or not weight:
            break
        level, full = (total - fixed) / weight, n
    return each.withColumn("target", F.when(at, F.col("bound")).otherwise(F.lit(level) * F.col("weight"))).drop("weight", "bound")


def flow(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], repeats: int = REPEATS) -> list[dict[int, int]]:
    """For each pattern the words that each of its sources gets: as much of the quotas as can be filled, at least cost.

    The k-th pass over a pattern costs k - 1 a word. A cheapest augmenting path costs what its first edge does, so filling
    all it can by one pass, then opening the next, is the successive-shortest-path order.
    """
    sent: list[dict[int, int]] = [dict.fromkeys(m, 0) for m in members]
    of: list[list[int]] = [[] for _ in quota]
    for p, m in enumerate(members):
        for s in m:
            of[s].append(p)
    left, free = list(quota), [0] * len(capacity)
    for _ in range(repeats):
        free = [f + c for f, c in zip(free, capacity, strict=True)]
        for p in range(len(capacity)):
            while free[p]:
                # The nearest source with room: straight, or by words of another pattern that can go elsewhere.
                came: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None}
                queue, end = deque([("p", p)]), None
                while queue and end is None:
                    kind, x = node = queue.popleft()
                    if kind == "s" and left[x]:
                        end = node
                        break
                    nxt = [("s", s) for s in members[x]] if kind == "p" else [("p", q) for q in of[x] if sent[q][x]]
                    for y in nxt:
                        if y not in came:
                            came[y] = node
                            queue.append(y)
                if end is None:
                    break
                path, at = [end], came[end]
                while at is not None:
                    path.append(at)
                    at = came[at]
                path.reverse()
                back = [sent[b[1]][a[1]] for a, b in zip(path, path[1:], strict=False) if a[0] == "s"]
                n = min([free[p], left[end[1]], *back])
                for a, b in zip(path, path[1:], strict=False):
                    if a[0] == "p":
                        sent[a[1]][b[1]] += n
                    else:
                        sent[b[1]][a[1]] -= n
                free[p] -= n
                left[end[1]] -= n
    return sent


def routed(found: DataFrame, aimed: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """(pattern, key, words): the flow from each pattern to each of its sources.

    Patterns and sources that hang together are a group; a group is one task's, and has a row for each pattern and source.
    """
    links = stored(found.select("pattern", "capacity", F.explode(F.transform("sources", _key)).alias("key")).join(aimed.select("key", F.round("target").cast("long").alias("quota")), "key"), "links")
    several = links.groupBy("pattern").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most")
    if several.limit(1).count():
        first = several.select("pattern", F.col("least").alias("a"))
        known = components(links.join(first, "pattern").select("a", F.col("key").alias("b")).where("a <> b")).select(F.col("node").alias("key"), F.col("label").alias("group"))
        grouped = links.join(known, "key", "left").withColumn("group", F.coalesce("group", "key"))
    else:
        grouped = links.withColumn("group", F.col("key"))  # each source by itself

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["pattern", "key"], kind="stable")
        pats, keys = pdf.drop_duplicates("pattern").reset_index(drop=True), pdf.drop_duplicates("key").reset_index(drop=True)
        number = {k: i for i, k in enumerate(keys["key"])}
        members = [[number[k] for k in g["key"]] for _, g in pdf.groupby("pattern", sort=True)]
        sent = flow([int(c) for c in pats["capacity"]], members, [int(q) for q in keys["quota"]], repeats)
        rows = [(p, keys["key"][s], n) for p, to in zip(pats["pattern"], sent, strict=True) for s, n in to.items()]
        return pd.DataFrame(rows, columns=["pattern", "key", "words"])

    return grouped.groupBy("group").applyInPandas(solve, "pattern string, key string, words long")


def chosen(rows: DataFrame, found: DataFrame, sent: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, size, sources, pattern, taken, for_key): whole documents whose words come near what each pattern gives.

    Whole passes take each document once. The rest is drawn in the seeded order: hash buckets that fit are taken whole, and
    in the bucket where it ends each document that still fits is taken, then one more if that comes nearer. A bucket has
    about `bucket` rows. for_key is the source whose share the document's last copy falls in.
    """
    total = sent.groupBy("pattern").agg(F.sum("words").alias("words"), F.array_sort(F.collect_list(F.struct("key", "words"))).alias("to"))  # as many as the pattern has sources
    plan = found.select("pattern", "capacity", "n").join(total, "pattern")
    passes = F.when(F.col("capacity") > 0, F.floor(F.col("words") / F.col("capacity"))).otherwise(0).cast("long")
    plan = plan.withColumn("passes", passes).withColumn("rest", F.col("words") - F.col("passes") * F.col("capacity"))
    plan = stored(plan.withColumn("buckets", F.ceil(F.col("n") / bucket).cast("long")).drop("n"), "plan")

    both = rows.join(plan.select("pattern", "passes", "rest", "buckets"), "pattern").withColumn("bucket", F.pmod(F.col("h"), F.col("buckets")))
    sums = both.groupBy("pattern", "bucket", "rest").agg(F.sum("size").alias("own"))
    upto = F.sum("own").over(Window.partitionBy("pattern").orderBy("bucket"))
    edges = sums.withColumn("upto", upto).withColumn("room", F.col("rest") - (F.col("upto") - F.col("own")))
    edges = stored(edges.select("pattern", "bucket", (F.col("upto") <= F.col("rest")).alias("whole"), "room"), "buckets")
    placed = both.join(edges, ["pattern", "bucket"]).drop("rest", "buckets")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "doc_id", "size"], kind="stable", na_position="first").reset_index(drop=True)
        room, size = int(pdf["room"][0]), pdf["size"].to_numpy()
        take, left, least = [False] * len(size), room, None
        for i, s in enumerate(size.tolist()):
            if s <= left:
                take[i] = True
                left -= s
            elif least is None or s < size[least]:
                least = i
        if least is not None and abs(left - int(size[least])) < left:
            take[least] = True
        return pdf.assign(more=take)[["doc_id", "size", "sources", "pattern", "h", "passes", "more"]]

    columns = ["doc_id", "size", "sources", "pattern", "h", "passes"]
    ends = (~F.col("whole")) & (F.col("room") > 0)
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    drawn = placed.where(ends).groupBy("pattern", "bucket").applyInPandas(draw, ", ".join(f"{c} {kinds[c]}" for c in columns) + ", more boolean")
    out = placed.where(~ends).select(*columns, F.col("whole").alias("more")).unionAll(drawn)
    # A document's place among its pattern's words, from its hash: shares of the sources are stretches of that line.
    at = (F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) * F.col("words")).cast("long")
    share = F.aggregate("to", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("string").alias("key")), lambda a, x: F.struct(
        (a["upto"] + x["words"]).alias("upto"), F.when(a["key"].isNull() & (at < a["upto"] + x["words"]), x["key"]).otherwise(a["key"]).alias("key")))["key"]
    taken = F.col("size") * (F.col("passes") + F.col("more").cast("long"))
    return out.join(plan.select("pattern", "words", "to"), "pattern").select("doc_id", "size", "sources", "pattern", taken.alias("taken"), F.when(taken > 0, share).alias("for_key"))


def mix(docs: DataFrame, sources: Column, doc_id: str = "doc_id", text: str = "text", weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): how many words of each document the mix takes, and each source's size and target.

    sources: a column with the array of a document's sources. A null in it is a source of its own, after all others; a
    document without sources (null or an empty array) is in that one. documents has (doc_id, size, sources, pattern, taken, for_key), a row for each row
    of docs: taken is 0 or a multiple of size up to `repeats`. Texts are counted whole, at any length; a null or empty one
    has no words and takes none. Repeated rows are documents of their own; rows that share an id stand beside each other in
    the seeded order, and in one bucket. Which of equal hashes comes first is told by the id, then the size. Further columns
    of docs are not looked at. Draws depend on seed and ids alone, so reruns agree. An empty table gives empty tables.
    """
    own = F.when(sources.isNull() | (F.size(sources) == 0), F.array(F.lit(None).cast("string"))).otherwise(sources)
    rows = sized(docs, own, doc_id, text, seed)
    found = patterns(rows)
    aimed = stored(targets(ranked(found), weights, share, repeats), "targets")
    sent = stored(routed(found, aimed, repeats), "flow")
    return chosen(rows, found, sent), aimed


def query(spark, sf_dir: str) -> DataFrame:
    """A row for each row of documents, each in its one source; see mix()."""
    docs, aimed = mix(table(spark, sf_dir, "documents"), F.array("source"))
    sources = aimed.select(F.col("key").alias("pattern"), "source_size", "target")
    return docs.join(sources, "pattern").select("doc_id", "size", "source_size", "target", "taken")
