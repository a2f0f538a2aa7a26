import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, row int, "
           "key string, n int, start int, shard int, tkey binary, u long")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with columns of clashing names
    that hold nulls."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, 1, None, 2, None, 7, None,
                 3) for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make
