"""Small tables for the tests of this folder."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None, parts=3):
    """A documents table with nulls, clashing extra columns and several partitions."""
    n = len(texts)
    rows = [(i if ids is None else ids[i], t, None if i % 3 else "en",
             (sources or ["s0"])[i % len(sources or ["s0"])], None if t is None else len(t))
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(parts) if n else spark.createDataFrame([], DOCS)


def clash(df, *names):
    """Extra columns whose names an operator may use itself."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("x") for n in names})
