import sys

import duckdb
import pytest

sys.path.insert(0, "/opt/tokenizers")

TEST_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{TEST_DIR}/{t}.parquet')")
    return con


def docs(spark, texts, **extra):
    """Documents 0, 1, ... with these texts."""
    return spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)


def plain(df):
    return [r.asDict() for r in df.collect()]
