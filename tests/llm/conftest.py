import pytest

from farsight.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def table(spark):
    """Documents (doc_id, text, source, lang, n_chars) with columns whose names clash with those used inside."""

    def make(rows):
        rows = [(i, t, *(rest or ("s",))) for i, t, *rest in rows]
        df = spark.createDataFrame([(i, t, s) for i, t, s, *_ in rows], "doc_id long, text string, source string")
        clash = "row id node bucket key size score taken kept root line words size_ bands lang_pred rejected copies"
        return df.selectExpr("*", *(f"'{name}' AS {name}" for name in clash.split()))

    return make
