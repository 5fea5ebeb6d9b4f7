"""Text profiles: keeps quality-controlled profiles of text logs up to date as documents arrive.

Sources write texts as instruments write samples: a source is a deployment, a language a profile, the document id the
order, the square root of the number of words the depth. Each new text is measured once. Then the profiles of the sources
that got new texts are made anew from the stored measures: texts that repeat the one before them are held values and go,
spikes of the letters per word against a rolling median go, and what is left is reduced on a grid of lengths.

A file stream with a checkpoint tells which files are new. Measures lie by (part, batch), profiles by part, and both are
replaced by partition, so a batch that is run again after a failure leaves the same tables.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from halocline.operators import binning, corrections
from halocline.operators.despike import Despiking, despike
from halocline.operators.model import Keys
from halocline.sources import naming

from . import common

KEYS = Keys("source", "lang", "doc_id")
MEASURES = "doc_id long, source string, lang string, words double, letters_per_word double, digest string, part string, batch long"
PROFILES = "source string, lang string, bin int, bin_center double, texts long, words double, letters_per_word double, part string"
COLUMNS = ["source", "lang", "bin", "bin_center", "texts", "words", "letters_per_word"]


@dataclass(frozen=True)
class Settings:
    window: int = 11
    rejection_percentile: float = 99.0
    step: float = 5.0
    files_per_batch: int = 64

    def despiking(self) -> Despiking:
        return Despiking(self.window, min(90.0, self.rejection_percentile / 2), self.rejection_percentile, method="raw_percentile")


def measured(documents: DataFrame) -> DataFrame:
    """A row a text. Texts without source are of `unknown`, without language `und`; those without id have no place and go. part: the source as a folder's name."""
    text = F.coalesce("text", F.lit(""))
    n = F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("double")
    letters = F.length(F.regexp_replace(text, "[ \\t-\\r]+", "")).cast("double")
    rows = documents.where("doc_id is not null").select(
        "doc_id", F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("lang", F.lit("und")).alias("lang"), n.alias("words"),
        F.when(n > 0, letters / n).alias("letters_per_word"), F.md5(text.cast("binary")).alias("digest"),
    )
    slug = naming.slug_column(F.col("source"))
    return rows.withColumn("part", F.when(slug != "", slug).otherwise("other"))


def profiles(measures: DataFrame, settings: Settings) -> DataFrame:
    """The grid of each source and language from the measures of whole sources, with how many texts each bin got.

    Of rows that share source and id, one counts: the least by words, then digest.
    """
    first = F.row_number().over(Window.partitionBy("source", "doc_id").orderBy("words", "digest", "lang"))
    log = measures.withColumn("_first", first).where("_first = 1").drop("_first")
    held = corrections.without_holds(F.col("digest"), KEYS.log()).isNull()
    log = log.withColumn("_held", held).withColumns({c: F.when(~F.col("_held"), F.col(c)) for c in ("words", "letters_per_word")}).drop("_held", "digest", "batch")
    clean, _ = despike(log, "letters_per_word", settings.despiking(), keys=KEYS)
    clean = clean.withColumn("z", F.sqrt("words")).withColumn("texts", F.when(F.col("words").isNotNull(), 1.0))
    methods = {"words": ("mean", {}), "letters_per_word": ("median", {}), "texts": ("mean", {})}
    grid = binning.bin_deployment(clean, {c: m for c, m in methods.items() if c != "texts"}, "z", settings.step, 0.0, keys=KEYS)
    counts = binning.with_bin(clean, binning.bin_edges(clean, "z", settings.step, 0.0, keys=KEYS), "z", KEYS).groupBy("source", "lang", "bin").agg(F.count("*").alias("texts"), F.first("part").alias("part"))
    parts = clean.select("source", "part").distinct()
    return grid.join(counts.drop("part"), ["source", "lang", "bin"], "left").join(parts, "source").select(*COLUMNS[:4], F.coalesce("texts", F.lit(0)).cast("long").alias("texts"), *COLUMNS[5:], "part")


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, settings: Settings = Settings()) -> list[dict[str, int]]:
    """Takes the files of `documents` that are new since the checkpoint, and ends; what each batch read and wrote.

    documents: a folder, or a pattern of folders and files. out/measures and out/profiles are Parquet, by part. Files
    already taken must not change.
    """
    took: list[dict[str, int]] = []

    def batch(rows: DataFrame, number: int) -> None:
        counted = common.Counted()
        common.replace_partitions(counted.of(measured(counted.of(rows, f"batch {number}, read from {documents}")), f"batch {number}, written to {out}/measures").withColumn("batch", F.lit(number).cast("long")), f"{out}/measures", "part", "batch")
        every = common.table(spark, f"{out}/measures", MEASURES)
        touched = every.where(F.col("batch") == number).select("part").distinct()
        # The join is on the partition column, so only the touched parts are read.
        found = profiles(every.join(touched, "part", "left_semi"), settings)
        common.replace_partitions(counted.of(found, f"batch {number}, written to {out}/profiles"), f"{out}/profiles", "part")
        took.append(counted.told())

    schema = spark.read.parquet(documents).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings.files_per_batch).parquet(documents)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if not took:
        common.log.info("nothing new in %s", documents)
    return took


def read(spark: SparkSession, out: str) -> DataFrame:
    """The profiles as they stand."""
    return common.table(spark, f"{out}/profiles", PROFILES).select(COLUMNS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on the whole table documents, twice into one folder; the second run finds nothing new."""
    out = common.own_folder(spark, "text-profiles")
    for _ in range(2):
        run(spark, f"{sf_dir}/documents.parquet*", out, f"{out}/checkpoint")
    return read(spark, out).withColumns({c: F.round(c, 9) for c in ("words", "letters_per_word")})


ORACLE = r"""with m0 as (select doc_id, coalesce(source, 'unknown') as source, coalesce(lang, 'und') as lang, coalesce(text, '') as text from documents where doc_id is not null),
m1 as (select doc_id, source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::double as words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::double as letters, md5(text) as digest from m0),
m2 as (select *, row_number() over (partition by source, doc_id order by words, digest, lang) as first from m1),
m3 as (select *, digest = lag(digest) over (partition by source order by doc_id) as held from m2 where first = 1),
m4 as (select doc_id, source, lang, case when not coalesce(held, false) then words end as words, case when not coalesce(held, false) and words > 0 then letters / words end as l from m3),
r as (select *, l - median(l) over (partition by source order by doc_id rows between 5 preceding and 5 following) as r from m4),
h as (select source, quantile_cont(abs(r), 0.99) as threshold from r group by 1),
c as (select r.source, lang, words, sqrt(words) as z, case when abs(r) > threshold then null else l end as l from r join h on r.source = h.source),
e as (select source, greatest(ceil(max(z) / 5.0), 1)::int as n from c where z is not null group by 1),
g as (select p.source, p.lang, unnest(range(0, e.n)) as bin from (select distinct source, lang from c) p join e on e.source = p.source),
b as (select source, lang, greatest(ceil(z / 5.0) - 1, 0)::int as bin, count(*) as texts, avg(words) as words, median(l) as l from c where z is not null group by all)
select g.source, g.lang, g.bin::int as bin, g.bin * 5.0::double + 2.5::double as bin_center, coalesce(b.texts, 0)::bigint as texts, round(b.words, 9) as words, round(b.l, 9) as letters_per_word
from g left join b on g.source = b.source and g.lang = b.lang and g.bin = b.bin"""

PATHS = {"documents": "folder with the documents as Parquet, or a pattern", "out": "folder for measures and profiles", "checkpoint": "folder for the stream's checkpoint"}

if __name__ == "__main__":
    sys.exit(common.command_line(__doc__.split("\n")[0], Settings, PATHS, run))
