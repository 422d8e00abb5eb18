import json

from cohortlens import sinks
from cohortlens.sources import files


def test_json_map_round_trip_and_reference_layout(spark, tmp_path):
    df = spark.createDataFrame([(i, f"name {i}") for i in range(50)], "member_id long, member_name string")
    path = str(tmp_path / "m")
    sinks.write_json_map(df, "member_id", "member_name", path, keys_per_object=7)
    back = files.read_json_map(spark, path, "string", "member_id", "member_name", wholetext=False)
    assert sorted((int(r.member_id), r.member_name) for r in back.collect()) == [(i, f"name {i}") for i in range(50)]
    pretty = tmp_path / "names.json"
    pretty.write_text(json.dumps({"a-1": "X Y", "b-2": "Z"}, indent=2))
    rows = files.read_json_map(spark, str(pretty), "string", "member_id", "member_name").collect()
    assert sorted((r.member_id, r.member_name) for r in rows) == [("a-1", "X Y"), ("b-2", "Z")]


def test_csv_and_records_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, "y")], "member_id long, v double, s string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert sorted(files.read_csv(spark, str(tmp_path / "c"), df.schema).collect()) == sorted(df.collect())
    sinks.write_json_records(df, str(tmp_path / "j"))
    assert sorted(files.read_json_records(spark, str(tmp_path / "j"), df.schema).collect()) == sorted(df.collect())


def test_feature_columns_sink(spark, tmp_path):
    from cohortlens import constants as K
    sinks.write_feature_columns(spark, list(K.FEATURE_COLUMNS), str(tmp_path / "f"))
    back = spark.read.json(str(tmp_path / "f")).orderBy("position").collect()
    assert [r.feature for r in back] == list(K.FEATURE_COLUMNS) and len(back) == 51


def test_jdbc_arguments_are_checked(spark):
    import pytest
    with pytest.raises(ValueError):
        files.read_jdbc(spark, "jdbc:postgresql://db/x", table="t", query="select 1")
    with pytest.raises(ValueError):
        files.read_jdbc(spark, "jdbc:postgresql://db/x", table="t", partition_column="id")
