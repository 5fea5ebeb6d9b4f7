"""A store of immutable shards with size-tiered compaction and a versioned manifest.

Arrivals are written as runs of small Parquet files. Compaction groups runs of similar size
(tiers by powers of the fan-out) and merges a tier that has enough of them into files of the
target size; merged runs count in higher tiers before anything is written, so a compaction
rewrites a byte once. Groups are merged side by side, a few at a time. Each change is a new
manifest that names the live runs. It is written aside and renamed to the next version, which
fails if another writer took that version; the writer then applies its change to the newer
manifest. Readers see one whole version or another. That needs a store whose rename is atomic and
does not replace, such as HDFS or a local disk; on an object store, writers must take turns.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import hadoop_fs, shared_dir, table

TARGET_BYTES = 128 << 20
FANOUT = 4
BASE_BYTES = 1 << 20  #: runs below this are all of tier 0
AT_ONCE = 4  #: groups that are merged at the same time


@dataclass(frozen=True)
class Run:
    name: str
    rows: int
    bytes: int
    files: int


def tier(size: int, fanout: int = FANOUT, base: int = BASE_BYTES) -> int:
    return max(0, int(math.floor(math.log(max(size, 1) / base, fanout) + 1e-9)))


def merges(runs: list[Run], target: int = TARGET_BYTES, fanout: int = FANOUT) -> list[list[Run]]:
    """Groups of runs to merge: tiers with fanout runs or more join, and what they make may join again.

    Runs made of whole target-sized files take no part; one that is left alone in its tier is rewritten if it has over
    twice the files it needs. Ties go by name, so the plan depends on the sizes alone.
    """
    ragged = lambda r: r.files > 2 * math.ceil(r.bytes / target)
    groups = [[r] for r in sorted(runs, key=lambda r: (r.bytes, r.name)) if r.bytes < target * r.files or r.bytes < target]
    size = lambda g: sum(r.bytes for r in g)
    while True:
        tiers: dict[int, list[list[Run]]] = {}
        for g in groups:
            tiers.setdefault(tier(size(g), fanout), []).append(g)
        full = [t for t in sorted(tiers) if len(tiers[t]) >= fanout]
        if not full:
            return [g for g in groups if len(g) > 1 or ragged(g[0])]
        joined = [r for g in tiers[full[0]] for r in g]
        groups = [g for t in tiers if t != full[0] for g in tiers[t]] + [joined]


class ShardStore:
    """root: a folder of any store that Spark reads. The first append fixes the schema."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fanout: int = FANOUT):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target_bytes, fanout
        fs, p = hadoop_fs(spark, f"{self.root}/manifest")
        fs.mkdirs(p)

    def version(self) -> int:
        """The last committed version, 0 before the first."""
        fs, p = hadoop_fs(self.spark, f"{self.root}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return max([0, *(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))])

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "runs": []}
        text = self.spark.read.text(f"{self.root}/manifest/v{version:010d}.json", wholetext=True).first()[0]
        found = json.loads(text)
        return found | {"runs": [Run(**r) for r in found["runs"]]}

    def _commit(self, change: Callable[[dict], dict | None], tries: int = 20) -> int:
        jvm = self.spark._jvm
        for _ in range(tries):
            old = self.manifest()
            new = change(old)
            if new is None:
                return old["version"]
            new |= {"version": old["version"] + 1, "runs": [asdict(r) for r in new["runs"]]}
            fs, aside = hadoop_fs(self.spark, f"{self.root}/manifest/.{uuid.uuid4().hex}")
            out = fs.create(aside, False)
            out.write(bytearray(json.dumps(new).encode()))
            out.close()
            to = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/v{new['version']:010d}.json")
            none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            try:
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, to, none)
                return new["version"]
            except Py4JJavaError as e:
                fs.delete(aside, False)
                if "FileAlreadyExists" not in str(e.java_exception):
                    raise
        raise RuntimeError(f"no version could be committed in {tries} tries")

    def _run(self, name: str) -> Run | None:
        """What a written run holds: files and bytes from the listing, rows from the footers."""
        fs, p = hadoop_fs(self.spark, f"{self.root}/runs/{name}")
        sizes = [s.getLen() for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet")] if fs.exists(p) else []
        rows = self.spark.read.parquet(f"{self.root}/runs/{name}").count() if sizes else 0
        return Run(name, rows, sum(sizes), len(sizes)) if rows else None

    def append(self, df: DataFrame, arrival: str | None = None) -> int:
        """Adds df as one run, or as one run for each value of the column `arrival`, in one job; the new version.

        The column stays a column. Without rows nothing is committed. Null values of `arrival` are one run.
        """
        batch = uuid.uuid4().hex[:12]
        if arrival is None:
            names = [batch]
            df.write.option("compression", "zstd").parquet(f"{self.root}/runs/{batch}")
        else:
            by = df.withColumn("_arrival", F.concat(F.lit(batch + "-"), F.sha2(F.coalesce(F.col(arrival).cast("string"), F.lit("\x00null")), 256).substr(1, 12)))
            by.write.option("compression", "zstd").partitionBy("_arrival").parquet(f"{self.root}/arriving/{batch}")
            fs, p = hadoop_fs(self.spark, f"{self.root}/arriving/{batch}")
            _, runs = hadoop_fs(self.spark, f"{self.root}/runs")
            fs.mkdirs(runs)
            names = []
            for s in fs.listStatus(p):
                folder = s.getPath().getName()
                if folder.startswith("_arrival="):
                    names.append(folder.removeprefix("_arrival="))
                    fs.rename(s.getPath(), hadoop_fs(self.spark, f"{self.root}/runs/{names[-1]}")[1])
            fs.delete(p, True)
        made = [r for r in map(self._run, names) if r]

        def change(old: dict) -> dict | None:
            return {"schema": old["schema"] or df.schema.json(), "runs": old["runs"] + made} if made else None

        return self._commit(change)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; of the last, if none is given. A store without rows has no schema yet, and raises."""
        from pyspark.sql.types import StructType

        found = self.manifest(version)
        if not found["runs"]:
            raise ValueError("the store has no rows yet")
        schema = StructType.fromJson(json.loads(found["schema"]))
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/runs/{r.name}" for r in found["runs"]))

    def compact(self) -> int:
        """Merges what the tiers ask for, a job for each group; the version after it. Rows are moved, never changed."""
        groups = merges(self.manifest()["runs"], self.target, self.fanout)

        def merge(group: list[Run]) -> None:
            name, paths = uuid.uuid4().hex[:12], [f"{self.root}/runs/{r.name}" for r in group]
            n_files = max(1, round(sum(r.bytes for r in group) / self.target))
            # Splits are joined where they are read: no shuffle.
            self.spark.read.parquet(*paths).coalesce(n_files).write.option("compression", "zstd").parquet(f"{self.root}/runs/{name}")
            made, gone = self._run(name), {r.name for r in group}

            def change(now: dict, made=made, gone=gone) -> dict | None:
                if not gone <= {r.name for r in now["runs"]}:
                    return None  # another compaction was first; the new run is garbage
                return {"schema": now["schema"], "runs": [r for r in now["runs"] if r.name not in gone] + [made]}

            self._commit(change)

        with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(merge), groups))
        return self.version()

    def vacuum(self, keep_versions: int = 1) -> int:
        """Deletes runs that none of the last versions names; how many. No writer may be at work."""
        last = self.version()
        live = {r.name for v in range(max(1, last - keep_versions + 1), last + 1) for r in self.manifest(v)["runs"]}
        fs, p = hadoop_fs(self.spark, f"{self.root}/runs")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in live]
        for x in gone:
            fs.delete(x, True)
        return len(gone)


def query(spark, sf_dir: str) -> DataFrame:
    """Appends documents with an arrival for each source, compacts, and reads the last version back: one row a document.

    Null sources are one arrival, null texts stay null (n_bytes and text_md5 are null), repeated rows stay repeated, and
    texts of any length are moved as they are. An empty table has no rows and commits no version. Further columns are
    kept in the store and left out here.
    """
    docs = table(spark, sf_dir, "documents")
    store = ShardStore(spark, f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}")
    store.append(docs, "source")
    store.compact()
    store.vacuum()
    kept = store.read() if store.version() else docs.limit(0)
    return kept.select("doc_id", "source", "lang", "n_chars", F.octet_length("text").cast("long").alias("n_bytes"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLE = "select doc_id, source, lang, n_chars, strlen(text)::bigint as n_bytes, md5(text) as text_md5 from documents"
