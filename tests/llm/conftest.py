import pytest

#: Columns that operators use inside, to clash with.
CLASHING = ["n", "label", "rep", "h", "c", "block", "rank", "key", "kept", "base", "row", "start", "host"]


@pytest.fixture
def documents(spark):
    """documents from (doc_id, text) pairs, with further columns whose names operators use inside."""

    def make(pairs):
        rows = [(i, t, "en", "src", None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in pairs]
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def folder(tmp_path):
    """A folder of driver tables from DataFrames by name."""

    def write(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def prose(n, seed=0, vocabulary=400):
    import random

    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x{r.randrange(9)}" for _ in range(n))


@pytest.fixture(scope="session")
def text():
    return prose


#: Texts that break naive code.
ODD = [None, "", " \t\n", "é", "a" * 30_000, "word " * 3_000, " x y", "\U0001f600 ok", "x\x00y z", "<|endoftext|> ab"]


@pytest.fixture(scope="session")
def odd():
    return ODD
