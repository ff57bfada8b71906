import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table."""
    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture()
def make_dir(spark, make_docs, tmp_path):
    """A data folder with the given documents (and more tables) as Parquet."""
    def make(rows=(), **tables):
        make_docs(list(rows)).write.parquet(f"{tmp_path}/documents.parquet")
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
