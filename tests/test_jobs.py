"""The jobs: whole tables against their SQL, growing input, backfills, and the command line's parts."""

import os

import pytest
from pyspark.sql import functions as F

from jobs import common, log_days, queries, text_profiles

from test_queries import canonical


def held_against(spark, duck, folder, got, sql):
    res = duck(folder).execute(sql)
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(got.columns)
    assert canonical(got.collect(), got.columns, sorted(columns)) == canonical(res.fetchall(), columns, sorted(columns))


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_whole_tables(spark, duck, name):
    held_against(spark, duck, "/root/testdata/sf0.001", queries.QUERIES[name](spark, "/root/testdata/sf0.001"), queries.ORACLES[name])


def documents(spark):
    """Driver documents and some that break naive code; ids repeat over sources and once within one."""
    rows = [(9001, None, None, None), (9002, "", "a/b c", "en"), (9003, " \t\n", "src1", "en"), (9003, "x y", "src1", "en"), (9004, "a b", "é", "en"), (9004, "a b", "", None), (None, "lost", "src1", "en"), (9005, "w " * 50_000, "src1", "de")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source", "lang").unionByName(odd).withColumn("words", F.lit("x"))


def test_text_profiles_take_only_what_is_new(spark, duck, tmp_path):
    docs, come, out, checkpoint = documents(spark).persist(), str(tmp_path / "come"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    parts = [docs.where("doc_id < 100 and source <> 'src3'"), docs.where("not (doc_id < 100 and source <> 'src3') or doc_id is null or source is null")]
    parts[0].coalesce(2).write.parquet(come)
    first = text_profiles.run(spark, come, out, checkpoint)
    assert [list(t.values())[:2] for t in first] == [[parts[0].count()] * 2]
    kept = files_of(f"{out}/measures")
    parts[1].coalesce(1).write.mode("append").parquet(come)
    second = text_profiles.run(spark, come, out, checkpoint)
    late = parts[1].count()
    assert [list(t.values())[:2] for t in second] == [[late, late - 1]] and set(kept) < set(files_of(f"{out}/measures"))
    stand = files_of(out)
    assert text_profiles.run(spark, come, out, checkpoint) == [] and files_of(out) == stand
    got = text_profiles.read(spark, out).withColumns({c: F.round(c, 9) for c in ("words", "letters_per_word")})
    (tmp_path / "all").mkdir()
    docs.toPandas().to_parquet(tmp_path / "all" / "documents.parquet")
    held_against(spark, duck, tmp_path / "all", got, text_profiles.ORACLE)


def test_text_profiles_run_a_failed_batch_again(spark, tmp_path, monkeypatch):
    come, out, checkpoint = str(tmp_path / "come"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    documents(spark).write.parquet(come)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(text_profiles, "profiles", broken)
        with pytest.raises(Exception, match="lost"):
            text_profiles.run(spark, come, out, checkpoint)
    n = spark.read.schema(text_profiles.MEASURES).parquet(f"{out}/measures").count()
    text_profiles.run(spark, come, out, checkpoint)
    assert spark.read.schema(text_profiles.MEASURES).parquet(f"{out}/measures").count() == n == documents(spark).where("doc_id is not null").count()
    assert text_profiles.read(spark, out).agg(F.sum("texts")).first()[0] > 0


def test_text_profiles_of_nothing(spark, tmp_path):
    documents(spark).limit(0).write.parquet(str(tmp_path / "come"))
    took = text_profiles.run(spark, str(tmp_path / "come"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert all(n == 0 for t in took for n in t.values())


def test_log_days_backfill(spark, tmp_path):
    """Two days run again are replaced, all others stay as they are, and slices don't change a thing."""
    events, out = "/root/testdata/sf0.001/events.parquet", str(tmp_path / "out")
    told = log_days.run(spark, events, out)
    assert list(told.values())[:2] == [1000, 1000]
    want, days = sorted(map(repr, log_days.read(spark, out).collect())), sorted(r["day"] for r in log_days.read(spark, out).select("day").distinct().collect())
    before = files_of(f"{out}/samples")
    again = log_days.Settings(first_day=days[1], last_day=days[1], rows_per_slice=64)
    assert list(log_days.run(spark, events, out, again).values())[1] < 1000
    after = files_of(f"{out}/samples")
    gone = set(before) - set(after)
    assert gone and all(f"day={days[1]}" in f for f in gone)
    assert sorted(map(repr, log_days.read(spark, out).collect())) == want


def test_log_days_of_odd_rows(spark, duck, tmp_path):
    rows = [(i, "2024-01-01 00:00:00", t, v) for i, (t, v) in enumerate([("a", 1.0), ("a", 1.0), ("a", None), ("a", 1.0), (None, 2.0), ("", 3.0), ("é/ü", 4.0), ("a", 1e9)] * 9)] + [(None, None, "a", 1.0), (500, None, "a", 7.0)]
    (tmp_path / "d").mkdir()
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("held", F.lit(1))
    df.toPandas().to_parquet(tmp_path / "d" / "events.parquet", coerce_timestamps="us")
    held_against(spark, duck, tmp_path / "d", log_days.query(spark, str(tmp_path / "d")), log_days.ORACLE)
    df.limit(0).write.parquet(str(tmp_path / "none"))
    assert list(log_days.run(spark, str(tmp_path / "none"), str(tmp_path / "nothing")).values())[:2] == [0, 0]


def test_settings_files(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert common.settings_from(text_profiles.Settings, f"{root}/jobs/text_profiles.toml") == text_profiles.Settings()
    assert common.settings_from(log_days.Settings, f"{root}/jobs/log_days.toml") == log_days.Settings()
    (tmp_path / "x.toml").write_text("windw = 3")
    with pytest.raises(ValueError, match="windw"):
        common.settings_from(log_days.Settings, str(tmp_path / "x.toml"))
    assert common.command_line("x", log_days.Settings, log_days.PATHS, None, ["--events", "a", "--out", "b", "--config", str(tmp_path / "x.toml")]) == 1
