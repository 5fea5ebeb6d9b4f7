"""Best-fit packing by length patterns and non-negative least squares.

Documents become token ids; only those longer than a sequence are cut, into full pieces after a
first one that may be shorter. What is packed is the histogram of piece lengths, which has at
most `capacity` entries at any input size: patterns of two or three lengths that fill a sequence
are enumerated, non-negative least squares fits how often each is used, the counts are rounded
to what is there, and best-fit decreasing packs the rest. Ranks of the pieces within their
length then tell each piece its sequence and its place.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stored, table

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k"

_loaded: dict = {}
#: Beyond these letters the two libraries may disagree on what a letter is; there, and where a special token's string may occur, the first decides.
_UNSURE = re.compile("[^\x00-ɏ]|<\\|")
_LONG = re.compile(r"\S{5000}")


def tokenizer(name: str = TOKENIZER):
    """A function from a text to its ids, a numpy array of '<u4': what `tokenizers` gives for name.json.

    tiktoken reads the same vocabulary and gives the same ids several times faster on plain Latin text.
    """
    if name not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def ids(text: str) -> np.ndarray:
            if _UNSURE.search(text) or _LONG.search(text):
                return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
            return np.array(fast.encode_ordinary(text), "<u4")

        _loaded[name] = ids
    return _loaded[name]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, name: str = TOKENIZER, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): how each document is cut.

    A null or empty text is the end token alone. Repeated rows give repeated pieces. Other columns don't matter. A text of
    any length is tokenized whole, a row at a time, and gives as many pieces as it needs.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(name)
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), []
            for key, t in zip(keys, batch.column(1), strict=True):
                ids = np.append(ids_of(t.as_py() or ""), np.uint32(end)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                borders = [0, *range(first, len(ids) + 1, capacity)]
                out += [(key, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(itertools.pairwise(borders))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths, 0 for none, that fill a sequence and occur; ascending in each row."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    low = lengths[lengths <= capacity // 2]
    pairs = np.stack([np.zeros_like(low), low, capacity - low], 1)
    a, b = (x.ravel() for x in np.meshgrid(lengths[lengths <= capacity // 3], lengths, indexing="ij"))
    c = capacity - a - b
    ok = (b >= a) & (c >= b)
    found = np.concatenate([pairs, np.stack([a[ok], b[ok], c[ok]], 1)])
    return found[have[found[:, 1]] & have[found[:, 2]]]


def nnls(rows: np.ndarray, b: np.ndarray, rounds: int = 60, at_once: int = 64) -> np.ndarray:
    """x >= 0 that nearly minimises |A x - b|², where column j of A counts the lengths in rows[j].

    Lawson-Hanson with several columns entering at once: the active columns stay few, so the counts survive rounding.
    """
    n, x, active = len(rows), np.zeros(len(rows)), np.zeros(0, int)
    weight = (rows > 0).astype(float)
    for _ in range(rounds):
        left = b - np.bincount(rows[active].ravel(), (weight[active] * x[active, None]).ravel(), len(b))
        gain = (left[rows] * weight).sum(1)
        gain[active] = 0
        new = np.argsort(-gain, kind="stable")[:at_once]
        new = new[gain[new] > 1e-6 * max(1.0, b.max())]
        if not len(new) or np.abs(left[1:]).sum() < 0.002 * b.sum():
            break
        active = np.union1d(active, new)
        for _ in range(20):
            a = np.zeros((len(b), len(active)))
            for k in range(rows.shape[1]):
                np.add.at(a, (rows[active, k], np.arange(len(active))), weight[active, k])
            s = np.linalg.solve(a.T @ a + 1e-6 * np.eye(len(active)), a.T @ b)
            if (s > 0).all():
                break
            active = active[s > 0]
        x = np.zeros(n)
        x[active] = np.maximum(s, 0) if len(s) == len(active) else 0
    return x


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Groups (how many sequences, the lengths in each) that use counts[L] pieces of each length L exactly.

    The fitted counts are rounded to the nearest, down, and, for inputs too small for whole patterns, to nothing; the
    rounding that needs the fewest sequences is taken.
    """
    left, full = counts.astype(np.int64).copy(), []
    if left[capacity]:
        full.append((int(left[capacity]), (capacity,)))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    rows = patterns(lengths, capacity) if len(lengths) else np.zeros((0, 3), int)
    x = nnls(rows, left.astype(float)) if len(rows) else np.zeros(0)
    tries = [_rounded(left, rows, k, capacity) for k in (np.floor(x + 0.5), np.floor(x), np.zeros(len(x)))]
    return full + min(tries, key=lambda groups: sum(n for n, _ in groups))


def _rounded(left: np.ndarray, rows: np.ndarray, wanted: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    left, groups = left.copy(), []
    for j in np.argsort(-wanted, kind="stable")[: np.count_nonzero(wanted)]:
        used = [int(v) for v in rows[j] if v]
        k = min(int(wanted[j]), *(int(left[v]) // used.count(v) for v in used))
        if k:
            groups.append((k, tuple(sorted(used, reverse=True))))
            for v in used:
                left[v] -= k
    return groups + best_fit(left, capacity)


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best-fit decreasing over a histogram: equal sequences are handled together."""
    room: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        count = int(left[length])
        for free in range(length, capacity + 1):
            while count and room[free]:
                n, slots = room[free].pop()
                fit = free // length
                k = min(n, count // fit)
                if k:
                    room[free - fit * length].append((k, slots + (length,) * fit))
                    count -= k * fit
                    if n > k:
                        room[free].append((n - k, slots))
                else:
                    room[free - count * length].append((1, slots + (length,) * count))
                    if n > 1:
                        room[free].append((n - 1, slots))
                    count = 0
            if not count:
                break
        fit = capacity // length
        if count >= fit:
            room[capacity - fit * length].append((count // fit, (length,) * fit))
        if count % fit:
            room[capacity - count % fit * length].append((1, (length,) * (count % fit)))
    return [g for groups in room for g in groups]


def places(groups: list[tuple[int, tuple[int, ...]]], capacity: int) -> tuple[np.ndarray, ...]:
    """Arrays sorted by (length, first rank): length * 2^40 + first rank, first sequence, offset."""
    used, base, out = np.zeros(capacity + 1, np.int64), 0, []
    for n, slots in groups:
        offset = 0
        for length in slots:
            out.append(((length << 40) + int(used[length]), base, offset))
            used[length] += n
            offset += length
        base += n
    table = np.array(sorted(out), np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut, a stored table as pieces() makes it, with sequence_id and offset.

    Each sequence holds at most `capacity` tokens without gaps. Equal lengths are ranked in buckets of bounded size,
    so one length that a third of all pieces have is still ranked by many tasks. An empty table gives no rows.
    """
    found = cut.groupBy("length").count().collect()  # one row a length, `capacity` at most
    counts = np.zeros(capacity + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["count"]
    key, base, offset = places(plan(counts, capacity), capacity)
    n_buckets = int(min(4096, max(16, counts.sum() // 200_000)))

    salted = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_buckets)))
    before = salted.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = before.select("length", "_bucket", (F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("_own", own).join(before, ["length", "_bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_own") - 1 + F.col("_before")).cast("long").alias("rank"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            at = np.searchsorted(key, (length << 40) + rank, "right") - 1
            sequence = base[at] + rank - (key[at] - (length << 40))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset[at])], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """One row for each piece of each document, with its sequence and place."""
    return pack(stored(pieces(docs, capacity=capacity, name=name), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY, name: str = TOKENIZER, end: int = END) -> DataFrame:
    """(sequence_id, ids, doc_ids): the token ids of each sequence, and which document each piece is from.

    docs needs unique ids. A group is one sequence, so it has at most `capacity` ids.
    """

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(name)
        for batch in batches:
            lists = [np.append(ids_of(t.as_py() or ""), np.uint32(end)).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "ids"])

    tokens = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(ids, "doc_id long, ids array<int>")
    parts = placed.join(tokens, "doc_id").select("sequence_id", F.struct("offset", "doc_id", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids")).alias("p"))
    whole = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return whole.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every piece of every row of documents; see pieces() and pack()."""
    return pack_documents(table(spark, sf_dir, "documents"))
