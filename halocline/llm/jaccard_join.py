"""Jaccard join of word n-gram sets by chosen paths.

Texts with the same set of shingles form a class; only one representative of each class takes
part. A run of the chosen-path join splits the representatives by minhash values at sampled
positions: a node's representatives go on to the children of about 1 / threshold positions,
so that a pair at the threshold is expected to stay together on one path. Small buckets are
compared by brute force on the sketches, large ones are split again, and those still large at
full depth, which hold copies of one text, are linked to their least member. Runs repeat until
a pair at the threshold is found with the target recall. All pairs within the groups found are
then compared exactly, on the whole texts, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, members, without
from .shared import stored, table
from .words import Block, blocks, mix, windows

SHINGLE = 5
THRESHOLD = 0.8
POSITIONS = 32  #: minhash values of a sketch
LIMIT = 200  #: largest bucket that is compared by brute force
DEPTH = 4
RECALL = 0.9999
SKETCH = 0.5  #: least share of equal minhash values of a pair that is compared exactly
BLOCK_DOCS, BLOCK_SHINGLES = 600, 400_000

_SEEDS = mix(np.arange(1, POSITIONS + 1, dtype=np.uint64)) | np.uint64(1)


def block_sets(block: Block, k: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct k-word shingles; a text of fewer words has one, of all its words."""
    h = block.hashes()
    s, out = windows(h, k), []
    for a, b in zip(block.doc[:-1], block.doc[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(s[a : b - k + 1]))
        else:
            out.append(windows(h[a:b], b - a)[:1] + np.uint64(b - a) if b > a else h[:0])
    return out


def _set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 128-bit key of each set in two parts, and its size."""
    sizes = np.array([len(s) for s in sets], np.int64)
    k1, k2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        h, at = np.concatenate(sets), (np.cumsum(sizes) - sizes)[full]
        k1[full] = np.add.reduceat(mix(h), at)
        k2[full] = np.bitwise_xor.reduceat(mix(h ^ _SEEDS[0]), at)
    return k1, k2, sizes


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, k1, k2, sig): number of shingles, a 128-bit key of the set, its minhash values (null for no words)."""

    def of_block(ids: pa.Array, block: Block) -> pa.RecordBatch:
        sets = block_sets(block)
        k1, k2, sizes = _set_keys(sets)
        sig = np.zeros((len(sets), POSITIONS), np.uint32)
        full = np.flatnonzero(sizes)
        if len(full):
            h = np.concatenate(sets)
            at = (np.cumsum(sizes) - sizes)[full]
            mixed = h ^ (h >> np.uint64(29))
            for j, seed in enumerate(_SEEDS):
                sig[full, j] = np.minimum.reduceat((mixed * seed) >> np.uint64(32), at)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * POSITIONS), pa.array(sig.view(np.int32).ravel()))
        return pa.RecordBatch.from_arrays([ids.slice(block.first, block.n_docs), pa.array(sizes), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), lists], ["doc_id", "n", "k1", "k2", "sig"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield of_block(batch.column(0), block)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(work, "doc_id long, n long, k1 long, k2 long, sig array<int>")


def survival(threshold: float, depth: int, share: float | None = None) -> float:
    """Chance that a pair with this share of equal minhash values (the threshold) shares a node at this depth of one run."""
    p, second, share = 1.0, 1 / threshold - 1, threshold if share is None else share
    for _ in range(depth):
        miss = 1 - share * p
        p = 1 - ((1 - second) * miss + second * miss * miss)
    return p


def recall_of(threshold: float, depth: int, runs: float) -> float:
    """Recall of pairs at the threshold: all runs use the same sketch, so this averages over the sketches a pair can have."""
    least, out = math.ceil(SKETCH * POSITIONS), 0.0
    for k in range(least, POSITIONS + 1):
        found = 1 - (1 - survival(threshold, depth, k / POSITIONS)) ** runs
        out += math.comb(POSITIONS, k) * threshold**k * (1 - threshold) ** (POSITIONS - k) * found
    return out


def runs_for(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """The least number of runs with this recall; where sketches alone miss more, with as little missed besides."""
    most = recall_of(threshold, depth, math.inf)
    want = recall if recall < most else most - (1 - recall)
    runs = 1
    while recall_of(threshold, depth, runs) < want:
        runs += 1
    return runs


def _children(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, rep, sig) -> the same one level down: one sampled position always, a second with the chance 1 / threshold - 1."""
    pick = lambda salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(POSITIONS)).cast("int")
    more = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 20)) < int((1 / threshold - 1) * (1 << 20))
    places = F.array_distinct(F.when(more, F.array(pick(0), pick(1))).otherwise(F.array(pick(0))))
    return rows.select("node", "rep", "sig", F.explode(places).alias("p")).select(F.xxhash64("node", "p", F.get("sig", F.col("p"))).alias("node"), "rep")


def candidate_links(reps: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, limit: int = LIMIT, depth: int = DEPTH) -> DataFrame:
    """(a, b): links whose components hold the pairs at the threshold, with the target recall. reps: stored (rep, sig)."""
    runs = runs_for(threshold, recall, depth)
    roots = F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.xxhash64(F.lit("run"), r))
    level, out = reps.select(F.explode(roots).alias("node"), "rep", "sig"), []
    for d in range(1, depth + 1):
        rows = stored(_children(level, threshold), "paths")
        counts = stored(rows.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size > 1"), "nodes")
        small = counts if d < depth else counts.where(F.col("size") <= limit)
        buckets = rows.join(small.where(F.col("size") <= limit).select("node"), "node").join(reps, "rep")
        buckets = buckets.groupBy("node").agg(F.collect_list(F.struct("rep", "sig")).alias("bucket"))  # `limit` rows at most
        out.append(stored(buckets.select("bucket").mapInArrow(_brute, "a long, b long").distinct(), "links"))
        large = counts.where(F.col("size") > limit)
        if not large.limit(1).count():
            break
        if d == depth:
            out.append(rows.join(large, "node").where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b")))
        level = rows.join(large.select("node"), "node").join(reps, "rep").select("node", "rep", "sig")
    links = out[0]
    for x in out[1:]:
        links = links.unionAll(x)
    return links


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least member of each member's component in a boolean matrix of links."""
    root = np.arange(len(linked), dtype=np.int32)
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(reach, root[None, :], np.int32(len(root))).min(1)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that span the pairs of each bucket whose sketches agree."""
    least = math.ceil(SKETCH * POSITIONS)
    for batch in batches:
        lists = batch.column(0)
        flat, offs = lists.flatten(), lists.offsets.to_numpy()
        offs = offs - offs[0]
        rep = flat.field("rep").to_numpy(zero_copy_only=False)
        sig = flat.field("sig").flatten().to_numpy().reshape(-1, POSITIONS)
        found = []
        for a, b in zip(offs[:-1], offs[1:], strict=True):
            order = np.argsort(rep[a:b], kind="stable")
            r, s = rep[a:b][order], sig[a:b][order]
            if len(r) == 2:
                if (s[0] == s[1]).sum() >= least and r[0] != r[1]:
                    found.append((r[:1], r[1:]))
                continue
            same = np.zeros((len(r), len(r)), np.int16)
            for j in range(POSITIONS):
                same += s[:, j, None] == s[None, :, j]
            root = _roots(same >= least)
            at = np.flatnonzero(r[root] != r)
            found.append((r[root[at]], r[at]))
        if found:
            x, y = (np.concatenate(z) for z in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])


def exact_links(texts: DataFrame, groups: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """(rep, root, links, split) for each member and block pair: its exact links there, and the least member linked.

    texts: (rep, text); groups: (rep, label, n). A group is dealt over blocks of about BLOCK_DOCS texts or BLOCK_SHINGLES; each
    pair of blocks is one group's work, so no task holds more than two blocks, however large the group.
    """
    sizes = groups.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_DOCS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)), F.lit(1)).cast("int").alias("n_blocks"))
    dealt = groups.join(stored(sizes, "sizes"), "label").withColumn("block", F.pmod(F.xxhash64("rep"), "n_blocks").cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j")))
    placed = stored(dealt.select("label", "rep", "block", "n_blocks", F.explode(pairs).alias("t")).select("label", "rep", "block", "n_blocks", "t.i", "t.j"), "placed")
    # By all three: a partitioning by the label alone would do for Spark, and put all blocks of a group into one task.
    n_tasks = max(64, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tasks = texts.join(placed, "rep").repartition(n_tasks, "label", "i", "j")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable").reset_index(drop=True)
        sets = [s for block in blocks(pa.array(pdf["text"], pa.large_string())) for s in block_sets(block, k)]
        n = np.array([len(s) for s in sets], np.int64)
        owner, flat = np.repeat(np.arange(len(sets)), n), np.concatenate(sets)
        _, column, df = np.unique(flat, return_inverse=True, return_counts=True)
        common = df[column] > 1
        number = np.cumsum(df > 1) - 1
        owner, column = owner[common], number[column[common]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        width = max(256, min(1 << 16, (8 << 20) // len(sets)))
        for lo in range(0, int((df > 1).sum()), width):
            a, b = np.searchsorted(column, [lo, lo + width])
            part = np.zeros((len(sets), width), np.float32)
            part[owner[a:b], column[a:b] - lo] = 1
            shared += part @ part.T
        linked = shared >= threshold * (n[:, None] + n[None, :] - shared) - 1e-6
        np.fill_diagonal(linked, False)
        if pdf["i"][0] != pdf["j"][0]:
            linked &= pdf["block"].to_numpy()[:, None] != pdf["block"].to_numpy()[None, :]
        rep = pdf["rep"].to_numpy()
        return pd.DataFrame({"rep": rep, "root": rep[_roots(linked)], "links": linked.sum(1).astype(np.int64), "split": pdf["n_blocks"] > 1})

    return tasks.groupBy("label", "i", "j").applyInPandas(compare, "rep long, root long, links long, split boolean")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each row of docs: doc_id, class_id, rep_id, n_links, n_copies, n_shingles.

    rep_id is the least doc_id with the same shingles, n_copies how many rows have them, n_links the number of other
    representatives whose sets have a Jaccard similarity of at least the threshold to this one; class_id is the least
    doc_id that is reached over such links. Null, empty and blank texts have no shingles: each is its own class, without
    links. A null doc_id takes no part: class_id, rep_id are null. Rows that share a doc_id are judged each by its own
    text: they are in one class only if their texts are linked. Texts of any length are compared whole, and an empty
    table gives no rows. Further columns of docs are ignored.
    """
    own = stored(sketches(docs, doc_id, text), "sketches")
    texts = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).alias("text"))
    if not _ambiguous(own):
        return _joined(own, lambda wanted: members(texts, "rep", wanted), threshold, recall)
    # Each text of an id gets a number of its own, in the order of the ids, and the texts' numbers go back to ids at the end.
    key = ["doc_id", "k1", "k2", "n"]
    numbers = stored(own.where("doc_id is not null").select(key).distinct().orderBy(key).withColumn("number", F.monotonically_increasing_id()), "numbers")
    numbered = stored(own.join(numbers, key, "left").select(F.col("number").alias("doc_id"), "n", "k1", "k2", "sig"), "sketches")

    def texts_of(wanted: DataFrame) -> DataFrame:
        of = wanted.join(numbers, wanted["rep"] == numbers["number"]).select("number", "doc_id", "k1", "k2", "n")
        some = members(texts, "rep", of.select(F.col("doc_id").alias("rep")).distinct())
        both = some.join(of.select(F.col("doc_id").alias("rep"), "number", "k1", "k2", "n"), "rep")
        keyed = both.select("rep", "text", "number", "k1", "k2", "n").mapInArrow(_keyed, "number long, text string, same boolean")
        return keyed.where("same").select(F.col("number").alias("rep"), "text")

    out = _joined(numbered, texts_of, threshold, recall)
    for c in ("doc_id", "class_id", "rep_id"):
        back = numbers.select(F.col("number").alias("_number"), F.col("doc_id").alias("_id"))
        out = out.join(back, out[c] == F.col("_number"), "left").withColumn(c, F.col("_id")).drop("_number", "_id")
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, text, number, k1, k2, n) -> whether the text is that of the key."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            k1, k2, sizes = _set_keys(block_sets(block))
            of = lambda i, block=block: batch.column(i).slice(block.first, block.n_docs).to_numpy()
            same = (k1.view(np.int64) == of(3)) & (k2.view(np.int64) == of(4)) & (sizes == of(5))
            yield pa.RecordBatch.from_arrays([batch.column(2).slice(block.first, block.n_docs), batch.column(1).slice(block.first, block.n_docs), pa.array(same)], ["number", "text", "same"])


def _joined(own: DataFrame, texts_of: Callable[[DataFrame], DataFrame], threshold: float, recall: float) -> DataFrame:
    """join() of stored sketches, where an id has one text. texts_of: (rep, text) rows of the ids in a one-column table, or more."""
    classes = own.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.min_by("sig", "doc_id").alias("sig"))
    classes = stored(classes, "classes")
    reps = classes.select("rep", "sig")
    groups = components(candidate_links(reps, threshold, recall))
    wanted = stored(groups.select(F.col("node").alias("rep"), "label").join(classes.select("rep", "n"), "rep"), "groups")
    texts = texts_of(wanted.select("rep"))
    texts = texts.dropDuplicates(["rep"]) if _repeats(own) else texts
    exact = stored(exact_links(texts, wanted, threshold), "exact")
    found = exact.groupBy("rep").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.max("split").alias("split"))
    if exact.where("split").limit(1).count():
        over = components(exact.where("split").select(F.col("rep").alias("a"), F.col("root").alias("b")))
        found = found.join(over, found["rep"] == over["node"], "left").select("rep", "links", F.when(F.col("split"), F.coalesce("label", "rep")).otherwise(F.col("root")).alias("root"))
    known = classes.select("k1", "k2", "n", "rep", "n_copies").join(found.select("rep", "links", "root"), "rep", "left")
    known = stored(known.select("k1", "k2", "n", F.col("rep").alias("rep_id"), "n_copies", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("root", "rep").alias("class_id")), "known")
    key = [own[c].eqNullSafe(known[c]) if c != "k1" else own[c] == known[c] for c in ("k1", "k2", "n")]
    joined = own.join(known, key[0] & key[1] & key[2], "left")
    named = lambda c: F.when(own["doc_id"].isNotNull(), F.coalesce(c, own["doc_id"]))
    return joined.select(own["doc_id"], named("class_id").alias("class_id"), named("rep_id").alias("rep_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"), own["n"].alias("n_shingles"))


def _repeats(own: DataFrame) -> bool:
    """Whether a doc_id occurs more than once."""
    return bool(own.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count())


def _ambiguous(own: DataFrame) -> bool:
    """Whether a doc_id has texts with different shingles."""
    least, most = (f(F.struct("k1", "k2", "n")) for f in (F.min, F.max))
    return bool(own.where("doc_id is not null").groupBy("doc_id").agg(least.alias("a"), most.alias("b")).where("a <> b").limit(1).count())


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows whose class has a smaller doc_id: one document of each near-duplicate group stays.

    Of rows that share a doc_id, all stay if the text of any is the least of its class.
    """
    found = join(docs, doc_id, text).where("doc_id is not null").groupBy("doc_id").agg(F.min(F.col("class_id") < F.col("doc_id")).alias("gone"))
    return without(docs, doc_id, stored(found.where("gone").select(F.col("doc_id").alias(doc_id)), "gone"))


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select doc_id, case when len(w) >= 5 then list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
k as (select doc_id, s, len(s)::bigint as n, md5(array_to_string(s, chr(10))) as k from s),
r as (select *, case when n > 0 then min(doc_id) over (partition by k, n) else doc_id end as rep,
             case when n > 0 then count(*) over (partition by k, n) else 1 end as copies from k),
t as (select doc_id, n, unnest(s) as t from r where doc_id = rep and n > 0),
p as (
  select a.doc_id as a, b.doc_id as b from t a join t b on a.t = b.t and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 10 * count(*) >= 8 * (a.n + b.n - count(*))),
c(a, b) as (select a, b from p union select c.a, p.b from c join p on c.b = p.a),
l as (select a, min(b) as b from c group by a),
n as (select a, count(*) as n from p group by a)
select r.doc_id, least(r.rep, coalesce(l.b, r.rep)) as class_id, r.rep as rep_id, coalesce(n.n, 0)::bigint as n_links, r.copies::bigint as n_copies, r.n as n_shingles
from r left join l on r.rep = l.a left join n on r.rep = n.a
"""
