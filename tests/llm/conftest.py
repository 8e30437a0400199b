import pytest

from sparkretail.llm import tables


@pytest.fixture(scope="session")
def docs(spark):
    """``(rows) -> documents`` from (doc_id, text[, source]) tuples, with
    extra columns whose names the operators use themselves."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 7, "x") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, rank int, block string")
    return make


@pytest.fixture(scope="session")
def real(spark, sf_small):
    return tables.documents(spark, sf_small)


EDGE = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "two words"), (6, "a b c d e f g"), (6, "a b c d e f g"),
        (7, "word " * 60_000), (8, "x" * 200_000), (9, "A B C D E F G")]
