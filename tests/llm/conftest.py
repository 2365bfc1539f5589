import duckdb
import pytest

from tidewater.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def documents(duck):
    """(doc_id, text, lang, source) rows of the smallest documents table."""
    return duck.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], DOC_SCHEMA)

    return make


@pytest.fixture()
def as_documents(spark, tmp_dir):
    """Write a frame as the ``documents`` (or other) table of a folder, for the registered queries."""
    def write(df, name="documents"):
        df.write.mode("overwrite").parquet(f"{tmp_dir}/{name}.parquet")
        return tmp_dir

    return write
