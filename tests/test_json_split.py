"""Large JSON objects read by byte ranges, against the reader of whole files and Python's own."""

import json
import random

import pytest

from cohortlens import sinks
from cohortlens.sources import files, json_split

SIZE = "spark.sql.files.maxPartitionBytes"
PIECES = ['"', "\\", "{", "}", "[", "]", ",", ":", "\n", "é", "日本", "x", " ", '",', '"},{"', "\\\\", "\\\",", "\t"]


@pytest.fixture
def block(spark):
    before = spark.conf.get(SIZE)
    yield lambda n: spark.conf.set(SIZE, n)
    spark.conf.set(SIZE, before)


def text(rng, longest=12):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(longest)))


def value(rng, depth=0):
    kind = rng.randrange(5 if depth < 3 else 2)
    if kind == 2:
        return {text(rng): value(rng, depth + 1) for _ in range(rng.randrange(4))}
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return None if kind == 4 and rng.random() < 0.3 else text(rng)


def pairs(df):
    return sorted((r.member_id, r.value) for r in df.collect())


@pytest.mark.parametrize("seed,indent,size", [(1, None, 37), (2, 2, 64), (3, 4, 500), (4, None, 100000)])
def test_strings_full_of_marks_over_many_blocks(spark, tmp_path, block, seed, indent, size):
    rng = random.Random(seed)
    obj = {f"{i}{text(rng)}": text(rng, 30) for i in range(60)}
    (tmp_path / "o.json").write_text(json.dumps(obj, indent=indent, ensure_ascii=bool(seed % 2)) + "\n", encoding="utf-8")
    whole = pairs(files.read_json_map(spark, str(tmp_path)))
    block(size)
    got = json_split.read_json_object(spark, str(tmp_path))
    assert pairs(got) == whole == sorted(obj.items())
    if size < 100:
        assert json_split._fragments(spark, str(tmp_path)).select("block").distinct().count() > 20


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_nested_values(spark, tmp_path, block, seed):
    """Each value is again an object; several files are read at once."""
    rng = random.Random(seed)
    want = []
    for f in range(3):
        obj = {f"{f}-{i}": {"a": text(rng), "b": [text(rng) for _ in range(rng.randrange(4))], "c": value(rng)} for i in range(15)}
        (tmp_path / f"{f}.json").write_text(json.dumps(obj, indent=rng.choice([None, 1])), encoding="utf-8")
        want += [(k, v["a"], v["b"]) for k, v in obj.items()]
    block(50)
    rows = json_split.read_json_object(spark, str(tmp_path), "struct<a:string,b:array<string>>").collect()
    assert sorted((r.member_id, r.value.a, r.value.b) for r in rows) == sorted(want)


def test_small_and_broken_files(spark, tmp_path, block):
    for i, content in enumerate(["{}", " {\n} \n", '{"a": null}', '{"b":"1","b":"2"}', '\n{ "c" : "}" }\n']):
        (tmp_path / f"{i}.json").write_text(content)
    block(3)
    assert sorted((r.member_id, str(r.value)) for r in json_split.read_json_object(spark, str(tmp_path)).collect()) == [
        ("a", "None"), ("b", "1"), ("b", "2"), ("c", "}")]
    for i, content in enumerate(['{"a": "1", "b": "2"', '{"a": "1", "b": "2}', '{"a": {"x": 1}, "b": ]}', '{"a": "1", b}']):
        broken = tmp_path / f"broken-{i}"
        broken.mkdir()
        (broken / "x.json").write_text(content)
        with pytest.raises(Exception, match="left open|MALFORMED"):
            json_split.read_json_object(spark, str(broken)).collect()


def test_objects_written_and_read(spark, tmp_path, block):
    rng = random.Random(9)
    rows = [(i, text(rng, 20) if i % 9 else None) for i in range(200)]
    path = str(tmp_path / "o")
    sinks.write_json_objects(spark.createDataFrame(rows, "member_id long, v string"), "member_id", "v", path, objects=3)
    found = {}
    for f in (tmp_path / "o").rglob("*.txt"):
        found |= json.loads(f.read_text(encoding="utf-8"))  # each file is one object
    assert found == {str(i): v for i, v in rows}
    block(200)
    got = {r.member_id: r.value for r in json_split.read_json_object(spark, path).collect()}
    assert got == found
