from cohortlens.llm.common import attach, free_names
from cohortlens.llm.mixing import emit
from cohortlens.llm.simhash import keep_one
from cohortlens.llm.warc import archive_folder
from cohortlens.session import scratch_root
from helpers import clash, documents

NAMES = ("__gone", "__fp", "__id", "__chosen", "__n", "__copies", "__key", "__grade", "__tail")


def test_columns_with_the_operators_own_names_stay(spark):
    words = " ".join(f"w{i}" for i in range(40))
    docs = clash(documents(spark, [words, words, "other text of its own here", None]), *NAMES)
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    twice = clash(documents(spark, [words, words, "other text"], ids=[1, 1, 2]), *NAMES)
    kept = keep_one(twice)
    assert kept.columns == twice.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    mixed = spark.createDataFrame([(0, 2), (1, 0), (2, 1), (3, 1)], "doc_id long, copies int")
    out = emit(docs, mixed)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [0, 0, 2, 3]
    assert all(r["__n"] == "x" for r in out.collect())


def test_attach_and_free_names(spark):
    big = clash(spark.createDataFrame([(1,), (None,), (2,), (1,)], "k long"), "__key", "__KEY_")
    small = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    for size in (2, 10**9):
        got = attach(big, small, "k", size)
        assert got.columns == [*big.columns, "v"]
        assert sorted((str(r.k), str(r.v)) for r in got.collect()) == [("1", "a"), ("1", "a"), ("2", "None"), ("None", "n")]
    assert free_names(big, "__key", "k", "z") == ["__key__", "k_", "z"]


def test_archives_lie_in_the_scratch_folder(spark):
    assert archive_folder(spark).startswith(scratch_root(spark) + "/")
