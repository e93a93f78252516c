import json
import os

import pytest
from pyspark.sql.types import StructType

from helpers import rows
from tideline.sources.ingest import ingest_files, rescue_json
from tideline.spec import Dataset
from tideline.streaming import writers


def put(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")


def load(spark, root, stream, name="t"):
    writers.write_streaming_table(stream, f"{root}/{name}", f"{root}/{name}_ck", Dataset(name))
    return writers.read_snapshot(spark, f"{root}/{name}")


@pytest.mark.parametrize("line, expected", [
    ('{"id":1,"zz":2}', (1, '{"zz":"2"}')),
    ('{"id":"x"}', (None, '{"id":"x"}')),
    ('{"id":3}', (3, None)),
    ('{"id":null}', (None, None)),
    ('{"id":1,"n":{"a":[1,2]}}', (1, '{"n":"{\\"a\\":[1,2]}"}')),
    ('{"id":1,"zz":null}', (1, None)),
    ('not json', (None, '{"_corrupt_record":"not json"}')),
])
def test_rescue(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    got = rescue_json(df, "line", StructType.fromDDL("id int")).first()
    assert tuple(got) == expected


def test_second_run_reads_only_new_files(spark, root):
    put(f"{root}/in/a.json", '{"id":1}', '{"id":2}')
    stream = ingest_files(spark, f"{root}/in", "json", schema="id long")
    assert rows(load(spark, root, stream)) == [(1,), (2,)]
    put(f"{root}/in/b.json", '{"id":3}')
    assert rows(load(spark, root, stream)) == [(1,), (2,), (3,)]
    assert rows(load(spark, root, stream)) == [(1,), (2,), (3,)]


def test_schema_is_stored_once_and_later_fields_are_rescued(spark, root):
    put(f"{root}/in/a.json", '{"id":1,"name":"x"}')

    def stream():
        return ingest_files(spark, f"{root}/in", "json", schema_location=f"{root}/schema",
                            rescued="_rescued_data")
    assert rows(load(spark, root, stream())) == [(1, "x", None)]
    put(f"{root}/in/b.json", '{"id":2,"name":"y","extra":true}', "")
    assert rows(load(spark, root, stream())) == [(1, "x", None), (2, "y", '{"extra":"true"}')]
    with open(f"{root}/schema/schema.json") as stored:
        assert [f["name"] for f in json.load(stored)["fields"]] == ["id", "name"]


def test_without_type_inference_columns_are_text(spark, root):
    put(f"{root}/in/a.json", '{"id":1,"n":{"a":1}}')
    stream = ingest_files(spark, f"{root}/in", "json", infer_types=False)
    assert rows(load(spark, root, stream)) == [("1", '{"a":1}')]


def test_csv_glob_with_inferred_types(spark, root):
    put(f"{root}/in/stats_1.csv", "id,amount,state", "1,2.5,CA")
    put(f"{root}/in/stats_2.csv", "id,amount,state", "2,3.5,NY")
    put(f"{root}/in/other.csv", "a", "1")
    stream = ingest_files(spark, f"{root}/in/stats_*", "csv", max_files=1)
    assert rows(load(spark, root, stream)) == [(1, 2.5, "CA"), (2, 3.5, "NY")]


def test_unknown_format_and_missing_files(spark, root):
    with pytest.raises(ValueError):
        ingest_files(spark, root, "xml")
    with pytest.raises(ValueError):
        ingest_files(spark, f"{root}/none", "json")


def test_schema_comes_from_all_files_at_any_depth(spark, root):
    put(f"{root}/in/a.json", '{"id":1}')
    put(f"{root}/in/x/y/z.json", '{"id":2,"late":5}')
    stream = ingest_files(spark, f"{root}/in", "json", schema_location=f"{root}/schema", rescued="_rescued_data")
    assert rows(load(spark, root, stream), "id", "late", "_rescued_data") == [(1, None, None), (2, 5, None)]


@pytest.mark.parametrize("line, rescued", [
    ('{"a":{"x":"bad","y":7},"l":[{"q":"no","z":1}]}', {"a", "l"}),
    ('{"a":{"x":1},"l":[{"q":2},{"q":null}]}', set()),
    ('{"a":{"x":1,"new":null},"l":[]}', set()),
    ('{"a":{"x":1,"new":2},"l":null}', {"a"}),
    ('{"a":{"x":1},"l":[{"q":2,"z":3}]}', {"l"}),
    ('{"a":5,"l":{"q":1}}', {"a", "l"}),
])
def test_nested_rescue(spark, line, rescued):
    schema = StructType.fromDDL("a STRUCT<x: INT>, l ARRAY<STRUCT<q: INT>>")
    got = rescue_json(spark.createDataFrame([(line,)], "line string"), "line", schema).first()
    kept = json.loads(got["_rescued_data"] or "{}")
    assert set(kept) == rescued
    for name in rescued:
        assert json.loads(kept[name]) == json.loads(line)[name]


def test_nested_fields_are_parsed_once_per_level(spark):
    def parses(depth):
        kind = "INT"
        for _ in range(depth):
            kind = f"STRUCT<a: {kind}, b: INT>"
        df = rescue_json(spark.createDataFrame([("{}",)], "line string"), "line", StructType.fromDDL(f"x {kind}"))
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")
    assert parses(5) - parses(4) == parses(4) - parses(3) <= 2


def test_csv_misfits_are_rescued(spark, root):
    put(f"{root}/in/a.csv", "id,name", "1,a", "x7,oops", "3,c,more", "4")
    stream = ingest_files(spark, f"{root}/in", "csv", schema="id INT, name STRING", rescued="_rescued_data")
    got = {(r.id, r.name): json.loads(r._rescued_data or "{}") for r in load(spark, root, stream).collect()}
    assert got[(1, "a")] == {} and got[(None, "oops")] == {"id": "x7"}
    assert got[(3, "c")] == {"_corrupt_record": "3,c,more"} and got[(4, None)] == {"_corrupt_record": "4"}


def test_csv_columns_follow_each_file_s_header(spark, root):
    put(f"{root}/in/a.csv", "id,city", "1,Rome")
    put(f"{root}/in/b [2]%20*.csv", "city,id", '"Oslo, N",2', "Paris,x")
    put(f"{root}/in/sub/c.csv", "id,mayor,city,id", "3,Ann,Bonn,9", "4,,Kiel", "5,Eve,Ulm,7,8")
    put(f"{root}/in/d.csv", "city", "Lima")
    put(f"{root}/in/e.csv", "id,city")
    stream = ingest_files(spark, f"{root}/in", "csv", schema="id INT, city STRING", rescued="_rescued_data")
    got = {(r.id, r.city): json.loads(r._rescued_data or "{}") for r in load(spark, root, stream).collect()}
    assert got == {
        (1, "Rome"): {}, (2, "Oslo, N"): {}, (None, "Paris"): {"id": "x"}, (None, "Lima"): {},
        (3, "Bonn"): {"mayor": "Ann", "id#2": "9"}, (4, "Kiel"): {"_corrupt_record": "4,,Kiel"},
        (5, "Ulm"): {"_corrupt_record": "5,Eve,Ulm,7,8"}}
    put(f"{root}/in/f.csv", "city,id", "Late,6")
    stream = ingest_files(spark, f"{root}/in", "csv", schema="id INT, city STRING", rescued="_rescued_data")
    assert load(spark, root, stream).where("city = 'Late'").first()["id"] == 6


def test_csv_schema_holds_the_columns_of_all_headers(spark, root):
    put(f"{root}/in/a.csv", "id,amount", "1,2", "2,3")
    put(f"{root}/in/b.csv", "amount,id,late", "2.5,7,x")
    put(f"{root}/in/c.csv", "id,amount", "n1,4")
    stream = ingest_files(spark, f"{root}/in", "csv", schema_location=f"{root}/schema")
    assert stream.schema.simpleString() == "struct<id:string,amount:double,late:string>"
    assert rows(load(spark, root, stream)) == sorted(
        [("1", 2.0, None), ("2", 3.0, None), ("7", 2.5, "x"), ("n1", 4.0, None)], key=repr)


def test_csv_separator_and_text_only(spark, root):
    put(f"{root}/in/a.csv", "id;name", "1;'a;b'")
    put(f"{root}/in/b.csv", "name;id", "c;2")
    stream = ingest_files(spark, f"{root}/in", "csv", infer_types=False, options={"sep": ";", "quote": "'"})
    assert rows(load(spark, root, stream)) == [("1", "a;b"), ("2", "c")]


def test_nothing_to_infer_from(spark, root):
    with pytest.raises(ValueError, match="no file"):
        ingest_files(spark, f"{root}/none", "json")
