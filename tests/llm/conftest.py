import pytest


@pytest.fixture()
def table(spark):
    """Make a documents table from (doc_id, text) pairs, with columns whose names clash with the operators' own."""

    def make(pairs, **columns):
        rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        for name, value in columns.items():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make
