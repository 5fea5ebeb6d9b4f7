"""Removes words in windows that an earlier document has, by FM-indexes over shards.

1. One pass over the texts takes each document's digest and its marks: of every 25 neighbouring
   26-word grams the least by hash, so any two equal windows of 50 words share their mark.
   Whole copies are settled by the digest.
2. Marks of two or more documents route text: each has a key, the place of the first document
   that has it, and all stretches of windows with such a mark go to the key's shard. A mark says
   that 26 words are shared; it says nothing of the window around them.
3. A shard holds its stretches as one compressed FM-index, built once and stored. The same
   stretches are streamed past it: backward search over the wavelet matrix gives the matching
   statistics, cut at the window's length, and with them the windows that a smaller id has.

A mark of many documents would fill a shard with as many stretches. Its windows are routed by
their own hashes instead: windows of one document go, of the others only the first one's are in the
index, and the rest is streamed past it by as many tasks as that needs. Who is first is found in
two steps, within groups of a bounded number of documents and then across these by the window's
hash, and stretches travel whole, so a mark costs a row for each document, however many share it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .graph import members
from .shared import stored, table
from .words import Block, blocks, mix, sliding, windows

WINDOW = 50
GRAM = 26
HOT = 64  #: marks of more documents than this are routed window by window
GROUP = 1024  #: documents whose windows of a hot mark meet in one group
KEY_WORDS = 2000  #: words of a document that make up one routing key
SHARD_WORDS, STREAM_WORDS = 200_000, 400_000
EMPTY = hashlib.sha256(b"").hexdigest()
_C = np.uint64(0xD6E8FEB86659FD93)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _minimizers(block: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, least gram hash of the window) at each word, and whether a window begins there."""
    gram = np.where(block.room(GRAM), mix(windows(h, GRAM)), _MOST)
    return gram, sliding(gram, WINDOW - GRAM + 1, np.minimum), block.room(WINDOW)


def _digests(block: Block, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits over each document's words in their order."""
    k1, k2 = np.zeros(block.n_docs, np.uint64), np.zeros(block.n_docs, np.uint64)
    full = np.flatnonzero(block.n_words())
    if len(full):
        place = mix((np.arange(len(h)) - np.repeat(block.doc[:-1], block.n_words())).astype(np.uint64))
        k1[full] = np.add.reduceat(mix(h + place), block.doc[full])
        k2[full] = np.bitwise_xor.reduceat(mix((h ^ _C) * _C + place), block.doc[full])
    return k1.view(np.int64), k2.view(np.int64)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_words, k1, k2, sha, marks, places) of each document: its different marks, and where each is first."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            h = block.hashes()
            gram, least, room = _minimizers(block, h)
            over = sliding(np.where(room, least, np.uint64(0))[::-1], WINDOW - GRAM + 1, np.maximum)[::-1]
            chosen = np.flatnonzero((gram == over) & (gram != _MOST))
            cuts = np.searchsorted(chosen, block.doc)
            marks, places = [], []
            for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                m, first = np.unique(gram[chosen[a:b]], return_index=True)
                marks.append(m.view(np.int64))
                places.append((chosen[a:b][first] - block.doc[d]).astype(np.int32))
            k1, k2 = _digests(block, h)
            raw = [block.data[a:b].tobytes() for a, b in zip(block.offsets[:-1], block.offsets[1:], strict=True)]
            sha = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.n_docs), pa.array(block.n_words()), pa.array(k1), pa.array(k2), pa.array(sha), pa.array(marks, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                ["doc_id", "n_words", "k1", "k2", "sha", "marks", "places"],
            )


_RUN = pa.struct([("key", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()), ("words", pa.binary())])
_HOT = pa.struct([("mark", pa.int64()), ("groups", pa.int32()), ("group", pa.int32()), ("start", pa.int32()), ("hashes", pa.binary())])
_FOUND = "doc_id long, k1 long, runs array<struct<key:long,start:int,n_words:int,words:binary>>, hot array<struct<mark:long,groups:int,group:int,start:int,hashes:binary>>, text string"


def _stretches(at: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, first, last) of neighbouring windows, at ascending places, with the same key."""
    cuts = np.concatenate([[0], np.flatnonzero((np.diff(at) != 1) | (np.diff(key) != 0)) + 1, [len(at)]]) if len(at) else np.zeros(1, int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(key[a]), int(at[a]), int(at[b - 1])


def _stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, marks: (mark, key, groups)) -> runs of windows by key; of hot marks, which have groups, runs with the windows' hashes, and the text."""
    for batch in batches:
        lists, offs = batch.column(2).flatten(), batch.column(2).offsets.to_numpy()
        offs = offs - offs[0]
        mark, key, groups = (lists.field(c).to_numpy(zero_copy_only=False) for c in ("mark", "key", "groups"))
        mark = mark.view(np.uint64)
        for block in blocks(batch.column(1)):
            h = block.hashes()
            _, least, room = _minimizers(block, h)
            whole, out = windows(h, WINDOW), []
            k1 = _digests(block, h)[0]
            for d in range(block.n_docs):
                a, b = block.doc[d], block.doc[d + 1]
                own = slice(offs[block.first + d], offs[block.first + d + 1])
                order = np.argsort(mark[own])
                known = mark[own][order]
                at = np.minimum(np.searchsorted(known, least[a:b]), len(known) - 1)
                shared = room[a:b] & (known[at] == least[a:b])
                at = order[at]
                busy = shared & (groups[own][at] > 0)
                one = np.flatnonzero(shared & ~busy)
                word = lambda s, e, a=a: block.data[block.starts[a + s] : block.ends[a + e - 1]].tobytes()
                runs = [{"key": k, "start": s, "n_words": e - s + WINDOW, "words": word(s, e + WINDOW)} for k, s, e in _stretches(one, key[own][at[one]])]
                many = np.flatnonzero(busy)
                share = np.uint64(batch.column(0)[block.first + d].as_py() % (1 << 64))
                hot = []
                for place, s, e in _stretches(many, at[many]):
                    n, m = int(groups[own][place]), mark[own][place]
                    hot.append({"mark": int(m.view(np.int64)), "groups": n, "group": int(mix(np.array([share ^ m]))[0] % np.uint64(n)), "start": s, "hashes": whole[a + s : a + e + 1].tobytes()})
                out.append((runs, hot, batch.column(1)[block.first + d].as_py() if hot else None))
            runs, hot, text = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.n_docs), pa.array(k1), pa.array(runs, pa.list_(_RUN)), pa.array(hot, pa.list_(_HOT)), pa.array(text, pa.string())],
                ["doc_id", "k1", "runs", "hot", "text"],
            )


def _joined(pdf: pd.DataFrame, *columns: tuple[str, str]) -> list[np.ndarray]:
    """Binary columns of arrays, each as one array; then the row of each value."""
    n = pdf[columns[0][0]].map(len).to_numpy() // np.dtype(columns[0][1]).itemsize
    return [*(np.frombuffer(b"".join(pdf[c]), kind) for c, kind in columns), np.repeat(np.arange(len(pdf)), n)]


def _firsts(h: np.ndarray, doc: np.ndarray, start: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each different hash: itself, its least (doc, start), and its greatest doc."""
    order = np.lexsort((start, doc, h))
    new = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
    return h[order][new], doc[order][new], start[order][new], np.maximum.reduceat(top[order], new)


def _within(pdf: pd.DataFrame) -> pd.DataFrame:
    """Stretches of one group of a mark -> its different windows with their first and last documents, dealt over buckets by hash."""
    h, row = _joined(pdf, ("hashes", "<u8"))
    n = np.bincount(row, minlength=len(pdf))
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    doc = pdf["doc_id"].to_numpy()[row]
    h, doc, start, top = _firsts(h, doc, pdf["start"].to_numpy()[row] + place, doc)
    groups = int(pdf["groups"].iloc[0])
    bucket = (mix(h) % np.uint64(groups)).astype(np.int64)
    out = []
    for b in range(groups):
        at = bucket == b if groups > 1 else doc < top
        if at.any():
            out.append((pdf["mark"].iloc[0], b, pdf["group"].iloc[0], h[at].tobytes(), doc[at].astype("<i8").tobytes(), start[at].astype("<i4").tobytes(), top[at].astype("<i8").tobytes()))
    return pd.DataFrame(out, columns=["mark", "bucket", "group", "hashes", "docs", "starts", "tops"])


def _across(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket's windows of all groups of a mark -> for each group those of its windows that two documents have, with the first."""
    h, doc, start, top, row = _joined(pdf, ("hashes", "<u8"), ("docs", "<i8"), ("starts", "<i4"), ("tops", "<i8"))
    known, doc, start, top = _firsts(h, doc, start, top)
    at = np.searchsorted(known, h)
    out = []
    for r, group in enumerate(pdf["group"]):
        mine = at[row == r]
        mine = mine[doc[mine] < top[mine]]
        if len(mine):
            out.append((pdf["mark"].iloc[0], group, known[mine].tobytes(), doc[mine].astype("<i8").tobytes(), start[mine].astype("<i4").tobytes()))
    return pd.DataFrame(out, columns=["mark", "group", "hashes", "docs", "starts"])


_OWNED = "doc_id long, k1 long, found array<struct<start:int,key:long,first:boolean>>"


def _owned(stretches: pd.DataFrame, firsts: pd.DataFrame) -> pd.DataFrame:
    """The windows of each stretch that two documents have, with the first one's key."""
    if not len(firsts) or not len(stretches):
        return pd.DataFrame([], columns=["doc_id", "k1", "found"], dtype=object)
    known, owner, place, _ = _joined(firsts, ("hashes", "<u8"), ("docs", "<i8"), ("starts", "<i4"))
    order = np.argsort(known)
    known, owner = known[order], owner[order]
    key = mix(mix(owner.astype(np.uint64)) + (place[order] // KEY_WORDS).astype(np.uint64)).view(np.int64)
    out = []
    for doc, k1, start, hashes in zip(*(stretches[c] for c in ("doc_id", "k1", "start", "hashes")), strict=True):
        h = np.frombuffer(hashes, "<u8")
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        has = np.flatnonzero(known[at] == h)
        if len(has):
            out.append((doc, k1, [{"start": start + int(i), "key": int(key[at[i]]), "first": bool(owner[at[i]] == doc)} for i in has]))
    return pd.DataFrame(out, columns=["doc_id", "k1", "found"])


_ROUTED = "doc_id long, k1 long, key long, start int, n_words int, words binary, indexed boolean, streamed boolean"


def _hot_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, k1, text, found: (start, key, first)) -> runs of windows with one key; the first document's are indexed, all others streamed."""
    for batch in batches:
        out: list[tuple] = []
        for doc, k1, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            block = next(blocks(pa.array([text.as_py()], pa.large_string())))
            start, key, first = (found.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "key", "first"))
            order = np.argsort(start, kind="stable")
            for own in (True, False):
                of = order[first[order] == own]
                for k, s, e in _stretches(start[of], key[of]):
                    out.append((doc, k1, k, s, e - s + WINDOW, block.data[block.starts[s] : block.ends[e + WINDOW - 1]].tobytes(), own, not own))
        if out:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], [x.split()[0] for x in _ROUTED.split(", ")])


def _hashed(column: pd.Series) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for block in blocks(pa.array(column, pa.large_binary())):
        out += np.split(block.hashes(), block.doc[1:-1])
    return out


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """The index of a shard's runs."""
    built = FMIndex(_hashed(pdf["words"]), pdf["doc_id"].to_numpy(), WINDOW)
    return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "index": [built.dump()]})


def _search(stream: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Streams runs past their shard's index: ranges of the windows that it has of a smaller id, as (doc_id, k1, lo, hi)."""
    if not len(index) or not len(stream):
        return pd.DataFrame({"doc_id": [], "k1": [], "lo": [], "hi": []}).astype({"doc_id": "int64", "k1": "int64", "lo": "int32", "hi": "int32"})
    shard = FMIndex.load(index["index"].iloc[0])
    runs = _hashed(stream["words"])
    n = np.array([len(r) for r in runs])
    run_of = np.repeat(np.arange(len(runs)), n)
    hit = shard.matches(np.concatenate(runs), run_of, np.repeat(stream["doc_id"].to_numpy(), n))
    at = np.flatnonzero(hit)
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(run_of[at]) != 0)]) if len(at) else np.zeros(0, bool)
    lo, hi = at[new], at[np.append(new[1:], True)] if len(at) else at
    run = run_of[lo]
    base = stream["start"].to_numpy()[run] - (np.cumsum(n) - n)[run]
    of = lambda c: stream[c].to_numpy()[run]
    return pd.DataFrame({"doc_id": of("doc_id"), "k1": of("k1"), "lo": (lo + base).astype(np.int32), "hi": (hi + base).astype(np.int32)})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, k1, text, ranges) -> the words that are left, if the ranges are of this text."""
    for batch in batches:
        out: list[tuple] = []
        for doc, k1, text, ranges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_string()), batch.column(3), strict=True):
            block = next(blocks(pa.array([text.as_py()], pa.large_string())))
            if int(_digests(block, block.hashes())[0][0]) != k1:
                continue  # another text with the same id
            n = len(block.starts)
            gone = np.zeros(n + 1, np.int64)
            np.add.at(gone, ranges.values.field("lo").to_numpy(zero_copy_only=False), 1)
            np.add.at(gone, ranges.values.field("hi").to_numpy(zero_copy_only=False) + WINDOW, -1)
            stays = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
            kept = b" ".join([block.word(i) for i in stays])
            out.append((doc, k1, n - len(stays), hashlib.sha256(kept).hexdigest(), kept.decode()))
        if out:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "k1", "n_removed", "sha", "kept"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False, search: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame] = _search) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed, kept_sha256, and with with_text kept_text, the kept words joined by one space (null where
    none went).

    A word goes if a window of 50 consecutive words over it also begins in a row with a smaller doc_id, judged on the
    input. Null, empty and blank texts have no words; texts under 50 words lose none. A row with a null doc_id loses
    nothing and takes nothing from others. Rows that share a doc_id take nothing from each other. Texts of any length
    are judged whole, and an empty table gives no rows. Further columns of docs are ignored. search decides, from streamed runs and the index of a shard, which windows count.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = stored(docs.mapInArrow(_survey, "doc_id long, n_words long, k1 long, k2 long, sha string, marks array<long>, places array<int>"), "survey")
    long = own.where(f"n_words >= {WINDOW} and doc_id is not null")
    firsts = stored(long.groupBy("k1", "k2", "n_words").agg(F.min("doc_id").alias("first"), F.min_by(F.arrays_zip(F.col("marks").alias("mark"), F.col("places").alias("place")), "doc_id").alias("marks")), "firsts")

    marks = firsts.select(F.col("first").alias("doc_id"), F.explode("marks").alias("m")).select("doc_id", "m.mark", "m.place")
    key = lambda doc, place: F.xxhash64(doc, F.floor(place / F.lit(KEY_WORDS)))
    # Stored, here and below: Spark splits a hot key of a join only if both sides are plain tables.
    shared = marks.groupBy("mark").agg(F.min(F.struct("doc_id", "place")).alias("o"), F.max("doc_id").alias("b"), F.count("*").alias("n"))
    groups = F.when(F.col("n") > HOT, F.ceil(F.col("n") / F.lit(GROUP))).otherwise(0).cast("int")
    shared = stored(shared.where("o.doc_id < b").select("mark", key(F.col("o.doc_id"), F.col("o.place")).alias("key"), groups.alias("groups")), "shared")
    marked = stored(marks.select("doc_id", "mark").join(shared, "mark").groupBy("doc_id").agg(F.collect_list(F.struct("mark", "key", "groups")).alias("marks")), "marks")  # a document's own, at most
    some = members(docs.where("doc_id is not null"), "doc_id", marked.select("doc_id")).join(marked, "doc_id")
    found = stored(some.select("doc_id", "text", "marks").mapInArrow(_stretched, _FOUND), "found")

    stretches = found.where(F.size("hot") > 0).select("doc_id", "k1", F.explode("hot").alias("h")).select("doc_id", "k1", "h.*")
    within = stretches.groupBy("mark", "group").applyInPandas(_within, "mark long, bucket int, group int, hashes binary, docs binary, starts binary, tops binary")
    across = within.groupBy("mark", "bucket").applyInPandas(_across, "mark long, group int, hashes binary, docs binary, starts binary")
    owned = stretches.groupBy("mark", "group").cogroup(across.groupBy("mark", "group")).applyInPandas(_owned, _OWNED)
    routed = owned.groupBy("doc_id", "k1").agg(F.flatten(F.collect_list("found")).alias("found"))  # a document's own, at most
    hot = found.where("text is not null").select("doc_id", "k1", "text").join(routed, ["doc_id", "k1"]).mapInArrow(_hot_runs, _ROUTED)
    plain = found.select("doc_id", "k1", F.explode("runs").alias("r")).select("doc_id", "k1", "r.*", F.lit(True).alias("indexed"), F.lit(True).alias("streamed"))
    runs = stored(plain.unionByName(hot), "runs")

    total = runs.where("indexed").agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    runs = runs.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(max(1, math.ceil(total / SHARD_WORDS)))))
    indexes = stored(runs.where("indexed").select("shard", "doc_id", "words").groupBy("shard").applyInPandas(_build, "shard long, index binary"), "indexes")
    stream = runs.where("streamed")
    salts = stored(stream.groupBy("shard").agg(F.ceil(F.sum("n_words") / F.lit(STREAM_WORDS)).cast("int").alias("salts")), "salts")
    dealt = stream.join(salts, "shard").select("shard", F.pmod(F.xxhash64("doc_id", "start"), "salts").cast("int").alias("salt"), "doc_id", "k1", "start", "n_words", "words")
    each = indexes.join(salts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "index")
    hits = dealt.groupBy("shard", "salt").cogroup(each.groupBy("shard", "salt")).applyInPandas(search, "doc_id long, k1 long, lo int, hi int")
    ranges = stored(hits.groupBy("doc_id", "k1").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")

    cut = members(docs.where("doc_id is not null"), "doc_id", ranges.select("doc_id").distinct()).join(ranges, "doc_id").select("doc_id", "k1", "text", "ranges")
    cut = cut.mapInArrow(_cut, "doc_id long, k1 long, n_removed long, sha string, kept string")
    cut = stored(cut if with_text else cut.drop("kept"), "cut").dropDuplicates(["doc_id", "k1"])
    base = own.select("doc_id", "n_words", "k1", "k2", "sha").join(firsts.select("k1", "k2", "n_words", "first"), ["k1", "k2", "n_words"], "left")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    base = base.withColumn("copy", copy)  # copies have no row in cut, and keys of their own
    cut = cut.select(F.col("doc_id").alias("id"), F.col("k1").alias("c1"), "n_removed", F.col("sha").alias("cut_sha"), *(["kept"] if with_text else []))
    done = base.join(cut, (base["doc_id"] == cut["id"]) & (base["k1"] == cut["c1"]), "left")
    return done.select(
        "doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"), *([F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept")).alias("kept_text")] if with_text else []),
    )


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs, whose ids are unique, with the words gone; texts that lose nothing stay as they are."""
    changed = dedup(docs, doc_id, text, with_text=True).where("n_removed > 0").select(F.col("doc_id").alias("_id"), F.col("kept_text").alias("_kept"))
    joined = docs.join(changed, docs[doc_id] == F.col("_id"), "left")
    return joined.withColumn(text, F.coalesce("_kept", text)).drop("_id", "_kept")


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w where len(w) >= 50),
h as (select doc_id, i, min(doc_id) over (partition by md5(array_to_string(w[i:i + 49], ' '))) < doc_id as gone from p),
t as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from w),
c as (
  select t.doc_id, t.i, word, max(case when gone then 1 else 0 end) over (partition by t.doc_id order by t.i rows between 49 preceding and current row) as gone
  from t left join h on t.doc_id = h.doc_id and t.i = h.i),
k as (select doc_id, count(*) filter (where gone = 1) as n, coalesce(string_agg(word, ' ' order by i) filter (where gone = 0), '') as kept from c group by doc_id)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(k.n, 0)::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from w left join k on w.doc_id = k.doc_id
"""
