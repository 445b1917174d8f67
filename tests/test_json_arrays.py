import json
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import json_arrays as J

ODD = ['plain', 'a } b', '{"x": 1}', 'quote " inside', 'back\\', 'back\\\\" }', '],[', '', 'ünï } 漢字', 'new\nline }', '}' * 9, '\\"}', '{{{']


def elements(n, seed=1):
    rng = random.Random(seed)
    return [
        {"id": i, "text": "".join(rng.choices(ODD, k=rng.randint(0, 5))), "more": {"deep": {"s": rng.choice(ODD)}, "list": [{"a": 1}, {}]}}
        for i in range(n)
    ]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_read_in_many_splits(spark, tmp_path, small_splits, indent):
    want = elements(150)
    (tmp_path / "a.json").write_text(json.dumps(want, indent=indent, ensure_ascii=False), encoding="utf-8")
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    got = {r.element: json.loads(r.json) for r in J.array_elements(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(want))


def test_several_files_empty_arrays_and_missing_fields(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "text": "}"}, {"id": 2}]\n')
    (tmp_path / "b.json").write_text("[ ]\n")
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text('\n[\n{"text": null, "id": "x"}\n]')
    got = J.read_json_array(spark, str(tmp_path), "id string, text string").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("1", "}"), ("2", None), ("x", None)], key=repr)


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": "b}]', '[{"a": {"b": 1}]', '[{"a": 1}}, {"a": 2}]'])
def test_broken_arrays_are_refused(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(J.BrokenArray):
        J.array_elements(spark, str(tmp_path))


def test_round_trip_of_partitions(spark, tmp_path):
    rows = [(i, ODD[i % len(ODD)], None if i % 3 else "x") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, t string, u string").repartition(5).where(F.col("id") != 7)
    J.write_json_array(df, str(tmp_path / "out"))
    for part in (tmp_path / "out").glob("part-*"):
        json.loads(part.read_text(encoding="utf-8"))
    got = J.read_json_array(spark, str(tmp_path / "out"), "id long, t string, u string").collect()
    assert sorted(map(tuple, got)) == [r for r in rows if r[0] != 7]
