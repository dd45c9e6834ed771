import duckdb
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 997}x{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def con(sf):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def texts(con):
    """(doc_id, text) of the whole documents table."""
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose names clash with inner ones."""
    passage = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen."
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "  \n\t ", None, None, None), (4, LONG, "en", "a", 1),
        (5, passage, "en", "b", 2), (5, passage, "en", "b", 2), (6, passage + " More words.", "en", None, 3),
        (None, passage, None, "b", None), (None, None, None, None, None), (7, "Ünïcode ſtraße Привет мир", "de", "c", 4),
        (8, "short", "en", "c", 5), (9, passage.upper(), "en", "c", 6), (5, "another text with that id", "en", "b", 7),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, COLUMNS)
    for name in ("words", "row", "key", "token", "node", "n", "root", "shard", "slot", "rank", "lane", "units", "id", "size", "found", "at",
                 "item_id", "toxic", "score", "start", "_hash", "_bucket", "group", "item"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
