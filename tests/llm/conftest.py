import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark, tmp_path):
    """Rows (doc_id, text[, lang, source]) as a table read from files, as operators expect it."""
    made = []

    def make(rows, schema=SCHEMA, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None)
                if schema == SCHEMA else r for r in rows]
        df = spark.createDataFrame(full, schema)
        for name, value in extra.items():
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit(value))
        path = str(tmp_path / f"t{len(made)}.parquet")
        made.append(path)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return make
