import os

import pytest
from pyspark.sql import functions as F

from tagseek.session import fresh_path
from tagseek.sources.json_tree import flatten_json, read_json_files, read_records, tag_files, typed_fields
from tagseek.sources.store import save_index

SAMPLE = """{"bookmark_tag": "ep1",
 "results": [
   {"text": "Hyper space jump", "start": 0.5, "end": 2, "ok": true,
    "words": [{"text": "Hyper", "start": 0.5}]},
   {"text": "it's a trap", "start": 3, "end": 4.25, "n": null, "tags": ["x", "y"]}]}"""


@pytest.fixture()
def folder(tmp_path):
    def write(**files):
        for name, value in files.items():
            (tmp_path / name.replace("__", ".")).write_text(value)
        return str(tmp_path)

    return write


def _files(spark, *values):
    return spark.createDataFrame([(str(i), str(i), v) for i, v in enumerate(values)], "filename string, filepath string, value string")


def test_which_files_are_read(spark, folder):
    path = folder(A__JSON="{}", __hidden__json="{}", _x__json="{}", x__txt="{}", b__json="{}")
    os.mkdir(f"{path}/sub")
    (open(f"{path}/sub/c.json", "w")).close()
    assert {r.filename for r in read_json_files(spark, path, underscored="skip").collect()} == {"A.JSON", "b.json"}
    with pytest.raises(ValueError, match="_x.json"):
        read_json_files(spark, path)
    assert read_json_files(spark, path, pattern="b*").count() == 1


def test_saved_records_keep_the_types_of_their_values(spark, folder):
    path = folder(a__json='{"text": "one", "v": 1}', b__json='{"text": "two", "v": 1.5}')
    docs = save_index(read_records(spark, path), fresh_path(spark, "types"), doc_buckets=1, term_buckets=1).documents
    kinds = docs.select(F.schema_of_variant(F.try_variant_get("fields", "$.v", "variant")).alias("kind"))
    assert sorted(r.kind for r in kinds.collect()) == ["BIGINT", "DECIMAL(2,1)"]


def test_the_session_is_left_as_it_was(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    many = ",".join("{}" for _ in range(int(before) // 400))
    assert flatten_json(_files(spark, *[f"[{many}]"] * 410)).count() == 410 * (int(before) // 400)
    assert spark.conf.get(name) == before


def test_records_of_a_transcript(spark, folder):
    rows = read_records(spark, folder(a__json=SAMPLE)).collect()
    assert len(rows) == 4 and {r.bookmark_tag for r in rows} == {"ep1"}
    assert {r.text for r in rows} == {None, "Hyper space jump", "it's a trap", "Hyper"}
    assert {(r.start, r.end) for r in rows if r.text == "it's a trap"} == {(3.0, 4.25)}
    assert len({r.doc_id for r in rows}) == 4


def test_fields_by_type(spark):
    nodes = flatten_json(_files(spark, SAMPLE, '{"text": 5, "v": 1}', '{"v": 1.5, "o": {}}'))
    got = {(r.filename, r.field, r.type, r.value) for r in typed_fields(nodes.select("filename", "fields")).collect()}
    assert ("0", "ok", "boolean", "true") in got and ("1", "text", "bigint", "5") in got
    assert ("1", "v", "bigint", "1") in got and ("2", "v", "double", "1.5") in got
    assert not {f for _, f, _, _ in got} & {"n", "tags", "o", "results"}
    wide = typed_fields(nodes, {"v": "double", "text": "string"}).where(F.col("depth") == 0)
    assert {(r.filename, r.v, r.text) for r in wide.collect()} == {("0", None, None), ("1", 1.0, None), ("2", 1.5, None)}


@pytest.mark.parametrize(
    "value, tag",
    [
        ('{"bookmark_tag": "", "a": {"bookmark_tag": "low"}}', ""),
        ('[{"a": 1}, {"bookmark_tag": "second"}]', "second"),
        ('{"a": {"bookmark_tag": "", "b": {"bookmark_tag": "under"}}, "c": {"bookmark_tag": "next"}}', "next"),
        ('{"a": {"bookmark_tag": "one"}, "b": {"bookmark_tag": "two"}}', "one"),
        ('{"bookmark_tag": 7, "a": [[{"bookmark_tag": "deep"}]]}', "deep"),
        ('{"x": []}', ""),
    ],
)
def test_tag_of_a_file(spark, value, tag):
    assert {r.bookmark_tag for r in tag_files(flatten_json(_files(spark, value))).collect()} == {tag}


def test_siblings_past_ten_keep_their_order(spark):
    objects = ",".join('{"bookmark_tag": "t%d"}' % i if i in (2, 10) else "{}" for i in range(12))
    assert tag_files(flatten_json(_files(spark, f"[{objects}]"))).first().bookmark_tag == "t2"


def test_missing_tag_and_malformed_file(spark):
    with pytest.raises(Exception, match="no bookmark_tag"):
        tag_files(flatten_json(_files(spark, "{}")), strict=True).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        flatten_json(_files(spark, '{"a": ')).collect()
    assert flatten_json(_files(spark, '{"a": ', "{}"), on_error="skip").count() == 1


def test_records_hold_their_own_scalars_only(spark):
    rows = flatten_json(_files(spark, '{"a": 1, "o": {"b": "x", "l": [1, {"c": true}]}, "n": null}')).select(F.to_json("fields").alias("j"))
    assert {r.j for r in rows.collect()} == {'{"a":1,"n":null}', '{"b":"x"}', '{"c":true}'}


def test_files_tagged_at_their_root_join_nothing(spark):
    nodes = flatten_json(_files(spark, '{"bookmark_tag": "a", "x": [{"y": 1}]}', '{"z": {"bookmark_tag": "b"}}', "[{}]"))
    tagged = tag_files(nodes)
    assert sorted((r.filename, r.depth, r.bookmark_tag) for r in tagged.collect()) == [
        ("0", 0, "a"), ("0", 2, "a"), ("1", 0, "b"), ("1", 1, "b"), ("2", 1, "")
    ]
    plan = tagged.where("filename = '0'")._jdf.queryExecution().optimizedPlan().toString()
    named, rest = plan.split("isnull(root_tag")[0], plan.split("isnull(root_tag")[1]
    assert plan.count("Join") == 1 and "isnotnull(root_tag" in named and "bookmark_tag" in rest
