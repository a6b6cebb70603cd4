import base64
import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattlake.operators import mail
from wattlake.sources import objects

AT = dt.datetime(2019, 12, 20)


def b64(text, url=False):
    encode = base64.urlsafe_b64encode if url else base64.b64encode
    return encode(text.encode()).decode()


@pytest.fixture
def messages(spark):
    rows = [
        (1, "PlugExport <a@example.com>", "s", AT, dt.datetime(2019, 12, 19, 7, 5, 9),
         [("a.txt", b64("no")), ("b.csv", b64("one")), ("c.csv.bak", b64("two")),
          ("D.CSV", b64("no"))]),
        (2, "plugexport@example.com", "s", AT + dt.timedelta(minutes=1), AT, []),
        (3, "other@example.com", "s", AT, AT, [("b.csv", b64("x"))]),
        (4, "plugexport@example.com", "Daily", dt.datetime(2019, 10, 11), AT, [("b.csv", b64("y"))]),
    ]
    return spark.createDataFrame(
        rows,
        "message_id long, sender string, subject string, created_at timestamp_ntz, "
        "received_at timestamp_ntz, attachments array<struct<name:string,content:string>>",
    )


def test_selection_ends_at_midnight(messages):
    chosen = mail.select_mail(messages, "plugexport", dt.date(2019, 10, 11), dt.date(2019, 12, 20))
    assert sorted(r.message_id for r in chosen.collect()) == [1, 4]
    narrow = mail.select_mail(
        messages, "plugexport", dt.date(2019, 10, 11), dt.date(2019, 12, 20), "daily")
    assert [r.message_id for r in narrow.collect()] == [4]


def test_numbers_count_all_attachments(messages):
    got = mail.export_attachments(messages.filter("message_id = 1"), "prefix", "export_").collect()
    assert sorted((r.object_key, bytes(r.body)) for r in got) == [
        ("prefix/export_2019-12-19_07:05:09_attachment1.csv", b"one"),
        ("prefix/export_2019-12-19_07:05:09_attachment2.csv", b"two"),
    ]


def test_parts(spark):
    parts = spark.createDataFrame(
        [
            (1, "0", None, None, None),
            (1, "0.0", "", b64("body", True), None),
            (1, "0.1", "first.csv", b64("??>>", True), None),
            (1, "0.2", "last.csv", None, "x"),
            (1, "0.2.0", "inside.csv", b64("deep", True), None),
            (1, "0.3", "empty.csv", "", "x"),
            (1, "0.4", "lost.csv", None, "missing"),
            (2, "0.9", "nine.csv", b64("nine", True), None),
            (2, "0.10", "ten.csv", b64("ten", True), None),
        ],
        "message_id long, part_path string, filename string, data string, attachment_id string",
    )
    stored = spark.createDataFrame(
        [(1, "x", b64("fetched", True)), (2, "x", b64("wrong message", True))],
        "message_id long, attachment_id string, data string",
    )
    flat = mail.flatten_parts(parts, stored)
    got = {(r.message_id, r.part_path): bytes(r.body) for r in flat.collect()}
    assert got == {
        (1, "0.1"): b"??>>", (1, "0.2"): b"fetched", (1, "0.2.0"): b"deep",
        (2, "0.9"): b"nine", (2, "0.10"): b"ten"}

    received = spark.createDataFrame(
        [(1, 1_576_740_309_500), (2, 0), (3, 0)], "message_id long, internal_date long")
    first = {r.message_id: (r.file_name, bytes(r.body))
             for r in mail.first_attachment(flat, received, stem="export_").collect()}
    # The walk takes the last sibling first, and a part before its own parts.
    assert first == {
        1: ("export_2019-12-19_07-25-09.csv", b"fetched"),
        2: ("export_1970-01-01_00-00-00.csv", b"ten")}


def files_below(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_objects_are_stored_under_their_keys(messages, spark, tmp_path):
    exported = mail.export_attachments(messages, "p", "e_")
    for _ in range(2):  # a job that comes again leaves no second file
        objects.write_objects(exported, f"file://{tmp_path}/objects")
        found = files_below(tmp_path / "objects")
        assert json.loads(found.pop("_SUCCESS"))["objects"] == len(found) == exported.select("object_key").distinct().count()
    assert found["p/e_2019-12-19_07:05:09_attachment1.csv"] == b"one"
    back = objects.read_objects(exported.select("object_key").distinct(), str(tmp_path / "objects")).collect()
    assert {r.object_key: bytes(r.body) for r in back} == found


def test_of_exports_with_one_key_the_last_message_counts(spark, tmp_path):
    rows = [(1, "k", b"old"), (3, "k", b"new"), (2, "k", b"mid"), (9, "a/b", b"")]
    exports = spark.createDataFrame(rows, "message_id long, object_key string, body binary").repartition(4)
    objects.write_objects(exports, str(tmp_path / "o"))
    found = files_below(tmp_path / "o")
    assert found.pop("_SUCCESS") == b'{"objects": 2, "bytes": 3}' and found == {"k": b"new", "a/b": b""}


def test_a_job_that_fails_leaves_whole_objects_only(spark, tmp_path):
    spark.dataSource.register(objects.ObjectStore)
    broken = F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    rows = spark.range(8).repartition(2).select(broken.alias("object_key"), F.lit(b"body").alias("body"))
    with pytest.raises(Exception, match="lost"):
        rows.write.format("objects").option("path", str(tmp_path / "o")).mode("append").save()
    found = files_below(tmp_path / "o") if (tmp_path / "o").exists() else {}
    assert "_SUCCESS" not in found and all(v == b"body" for v in found.values())
    assert not any(k.startswith("_temporary") for k in found)


def test_tasks_that_run_twice_store_the_same(tmp_path):
    batch = pa.RecordBatch.from_pydict({"object_key": ["x/1", "2"], "body": [b"one", b"two"]}, pa.schema([("object_key", pa.string()), ("body", pa.binary())]))
    writer = objects.ObjectWriter(str(tmp_path))
    told = [writer.write(iter([batch])) for _ in range(2)]  # the first attempt is lost after its work
    writer.commit(told[1:])
    found = files_below(tmp_path)
    assert json.loads(found.pop("_SUCCESS")) == {"objects": 2, "bytes": 6} and found == {"x/1": b"one", "2": b"two"}


def nested(depth, width, path="0"):
    """A tree of parts and its (path, name, body) rows in any order."""
    name = f"f{path}" if len(path) % 4 else ""
    part = {"filename": name, "body": {"data": base64.urlsafe_b64encode(path.encode()).decode()} if depth % 2 else {"attachmentId": path}}
    rows = [(path, name, path.encode())] if name else []
    if depth > 1:
        children = [nested(depth - 1 - i, 1 if i else width, f"{path}.{i}") for i in range(width) if depth - 1 - i > 0]
        part["parts"] = [p for p, _ in children]
        rows += [r for _, more in children for r in more]
    return part, rows


@pytest.mark.parametrize("depth", [1, 2, 5, 8])
def test_nested_parts_at_any_depth(spark, depth, tmp_path):
    count = iter(range(99))

    def keep(df):
        path = str(tmp_path / str(next(count)))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    part, rows = nested(depth, 2)
    messages = [(1, json.dumps(part)), (2, "{broken"), (3, None), (4, "{}"), (5, json.dumps(nested(1, 0)[0]))]
    flat = mail.walk_parts(spark.createDataFrame(messages, "message_id long, payload string"), keep)
    ids = sorted({r.attachment_id for r in flat.collect() if r.attachment_id})
    stored = [(m, i, base64.urlsafe_b64encode(i.encode()).decode()) for m in (1, 5) for i in ids]
    attachments = spark.createDataFrame(stored, "message_id long, attachment_id string, data string")
    got = mail.flatten_parts(flat, attachments).collect()
    assert sorted((r.part_path, r.filename, bytes(r.body)) for r in got if r.message_id == 1) == sorted(rows)
    assert {r.message_id for r in got} <= {1, 5}
    # The first attachment is the one a stack walk meets first.
    received = spark.createDataFrame([(1, 0)], "message_id long, internal_date long")
    first = mail.first_attachment(mail.flatten_parts(flat, attachments), received).collect()
    stack, order = [("0", part)], []
    while stack:
        path, now = stack.pop()
        order.append((path, now["filename"]))
        stack += [(f"{path}.{i}", p) for i, p in enumerate(now.get("parts", []))]
    named = [p for p, name in order if name]
    assert [bytes(r.body).decode() for r in first] == named[:1]
