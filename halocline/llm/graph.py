"""Connected components and membership filters as joins and combinable aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .url_filter import bloom, maybe_listed


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, label): the least node of each node's component. edges: (a, b), in any direction, loops and repeats allowed.

    Labels spread to neighbours and then jump along themselves, so paths shorten by more than half a round. A node of
    any degree is only ever joined and aggregated with min; nothing is collected. Nodes without edges don't occur.
    """
    both = stored(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.where("a <> b").select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("label")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        # Stored, as the edges are: Spark splits a hot key of a join only if both sides are plain tables.
        best = stored(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        jump = best.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = stored(best.join(jump, best["label"] == jump["via"]).select("node", F.least("label", "far").alias("label"), (F.least("label", "far") < F.col("old")).alias("changed")), "labels")
        labels = new.select("node", "label")
        if not new.where("changed").limit(1).count():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _blocks_for(ids: DataFrame, most_blocks: int) -> int:
    return min(most_blocks, 1 << max(0, (ids.count() * 16 // 512).bit_length()))


def members(docs: DataFrame, doc_id: str, ids: DataFrame, most_blocks: int = 1 << 16) -> DataFrame:
    """Rows of docs whose id is in ids (one column of that name), and few others.

    A blocked Bloom filter of at most most_blocks blocks (64 bytes each) is broadcast, so rows that are not members
    mostly stay out of the shuffle of a later join. With more ids than it is made for it lets more rows pass.
    """
    n_blocks = _blocks_for(ids, most_blocks)
    return maybe_listed(docs, doc_id, bloom(ids, doc_id, n_blocks), n_blocks, most_blocks)


def without(docs: DataFrame, doc_id: str, ids: DataFrame, most_blocks: int = 1 << 16) -> DataFrame:
    """Rows of docs whose id is not in ids (one column of that name, distinct, stored); rows with a null id stay.

    What the filter of members() can't hold stays without a shuffle; only the few rows that it may hold are joined.
    """
    n_blocks = _blocks_for(ids, most_blocks)
    rows = bloom(ids, doc_id, n_blocks)
    sure = maybe_listed(docs, doc_id, rows, n_blocks, most_blocks, inverse=True)
    known = ids.select(F.col(doc_id).alias("_known"))
    # Not an anti-join, which would be pushed below the filter.
    unsure = maybe_listed(docs, doc_id, rows, n_blocks, most_blocks).join(known, F.col(doc_id) == F.col("_known"), "left")
    return sure.unionAll(unsure.where("_known is null").select(docs.columns))
