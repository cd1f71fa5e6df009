"""Readers, the user-written source, writers and user functions."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import udfs
from tidemark.sinks import writers
from tidemark.sources import custom, files, kafka
from tidemark.streaming.run import StreamRun


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    (path / "a.txt").write_text("ws_001,1577844001,45\nws_002,1577844015,43\n")
    (path / "b.txt").write_text("ws_003,1577844020,42\n")
    return str(path)


SCHEMA = "id string, ts long, vc int"
ALL = [("ws_001", 1577844001, 45), ("ws_002", 1577844015, 43), ("ws_003", 1577844020, 42)]


def test_lines_of_file_folder_and_uri(spark, folder):
    assert files.read_lines(spark, f"{folder}/a.txt").count() == 2
    assert files.read_lines(spark, f"file://{folder}").count() == 3


def test_delimited_batch_and_stream(spark, folder):
    assert rows_of(files.read_delimited(spark, folder, SCHEMA), "id", "ts", "vc") == ALL
    run = StreamRun(spark, "csv")
    rows = files.read_delimited(spark, folder, SCHEMA, stream=True, files_per_batch=1)
    assert rows_of(run.to_files(rows), "id", "ts", "vc") == ALL


def test_declared_table(spark, folder):
    spec = files.TableSpec(
        "sensor", SCHEMA, "csv", folder, {"sep": ","}, {"rt": "timestamp_seconds(ts)"}, "rt", "5 seconds")
    spec.register(spark)
    found = spark.sql("SELECT id, sum(vc) AS s FROM sensor WHERE vc > 42 GROUP BY id")
    assert rows_of(found, "id", "s") == [("ws_001", 45), ("ws_002", 43)]
    stream = spec.read(spark, stream=True)
    assert stream.isStreaming and "EventTimeWatermark" in stream._jdf.queryExecution().toString()


def test_catalog_table(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW known AS SELECT 1 AS one")
    assert files.read_table(spark, "known").first().one == 1


def test_user_written_source(spark, folder):
    custom.register(spark)
    batch = spark.read.format("record_folder").schema(SCHEMA).load(folder)
    assert rows_of(batch, "id", "ts", "vc") == ALL
    assert batch.rdd.getNumPartitions() == 2
    run = StreamRun(spark, "custom")
    stream = spark.readStream.format("record_folder").schema(SCHEMA).load(folder)
    out = []
    query = stream.writeStream.foreachBatch(lambda df, i: out.extend(tuple(r) for r in df.collect())).option(
        "checkpointLocation", run.path).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(out) == ALL


def test_kafka_options_and_messages(spark):
    options = kafka.source_options("h:9092", "t", {"t": {0: 5, 1: 7}}, "g", 100)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5, "1": 7}}
    assert options["kafka.group.id"] == "g" and options["maxOffsetsPerTrigger"] == "100"
    assert kafka.source_options("h", "t", "earliest")["startingOffsets"] == "earliest"
    df = files.from_rows(spark, ALL, SCHEMA)
    messages = kafka.encode(df, ("id", "ts"))
    assert messages.columns == ["key", "value"]
    assert messages.first().key == "ws_001_1577844001"
    assert rows_of(kafka.decode(messages, SCHEMA), "id", "ts", "vc") == ALL
    lines = files.from_rows(spark, [("ws_001,1577844001,45",)], "value string")
    assert rows_of(kafka.decode(lines, SCHEMA, "csv"), "id", "vc") == [("ws_001", 45)]


def test_csv_sink(spark, folder, tmp_path):
    rows = files.read_delimited(spark, folder, SCHEMA, stream=True).filter("vc > 42")
    writers.append_delimited(rows, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(
        availableNow=True).start().awaitTermination()
    assert rows_of(files.read_delimited(spark, str(tmp_path / "out"), SCHEMA), "id", "vc") == [
        ("ws_001", 45), ("ws_002", 43)]


def test_print(spark, folder, capsys):
    assert writers.print_rows(files.from_rows(spark, ALL, SCHEMA)) is None
    assert "ws_001" in capsys.readouterr().out
    stream = files.read_delimited(spark, folder, SCHEMA, stream=True)
    assert writers.print_rows(stream) is not None


def test_keyed_table(spark, tmp_path):
    table = writers.KeyedTable(spark, str(tmp_path / "t"), ["k"], "seq")
    schema = "k int, v string, seq int, op string"
    first = files.from_rows(spark, [(1, "a", 1, "I"), (1, "b", 2, "U"), (2, "x", 1, "I")], schema)
    second = files.from_rows(spark, [(2, "x", 3, "D"), (3, "n", 3, "I"), (9, "?", 3, "D")], schema)
    table.upsert(first, 0, "op")
    table.upsert(second, 1, "op")
    table.upsert(second, 1, "op")  # a repeated batch
    assert rows_of(table.current(), "k", "v") == [(1, "b"), (3, "n")]
    assert rows_of(table.current(before_batch=1), "k", "v") == [(1, "b"), (2, "x")]
    changed = table.changes_of(1)
    assert rows_of(changed, "row_kind", "k") == [("+I", 3), ("-D", 2)]


def test_document_ids(spark):
    df = files.from_rows(spark, [("a", 1)], "x string, y int")
    assert df.select(writers.document_id(["x", "y"], "$").alias("i")).first().i == "a$1"


def test_chunks_of_ten(spark, tmp_path):
    target = str(tmp_path)

    def write(chunk, batch_id):
        import os
        import uuid

        with open(os.path.join(target, f"{batch_id}-{uuid.uuid4().hex}.txt"), "w") as out:
            out.write(str(len(chunk)))

    writers.in_chunks(write, 10)(spark.range(25).coalesce(1), 4)
    sizes = sorted(int(open(p).read()) for p in glob.glob(f"{target}/4-*.txt"))
    assert sizes == [5, 10, 10]


@pytest.mark.parametrize("dialect, text", [
    ("mysql", "INSERT INTO t (id, vc) SELECT id, vc FROM s ON DUPLICATE KEY UPDATE vc = VALUES(vc)"),
    ("mysql-replace", "REPLACE INTO t (id, vc) SELECT id, vc FROM s"),
    ("postgresql", "INSERT INTO t (id, vc) SELECT id, vc FROM s ON CONFLICT (id) DO UPDATE SET vc = EXCLUDED.vc"),
    ("oracle", "MERGE INTO t t USING s s ON (t.id = s.id) WHEN MATCHED THEN UPDATE SET t.vc = s.vc "
               "WHEN NOT MATCHED THEN INSERT (id, vc) VALUES (s.id, s.vc)"),
])
def test_merge_statements(dialect, text):
    assert writers.merge_statement(dialect, "t", "s", ["id"], ["id", "vc"]) == text


def test_registered_functions(spark):
    udfs.register(spark)
    assert spark.sql("SELECT mask_digits('1111222233331111') AS m").first().m == "1111********1111"
    assert spark.sql("SELECT mask_digits('123456', 1, 1) AS m").first().m == "1****6"
    assert spark.sql("SELECT mask_digits(CAST(NULL AS STRING)) AS m").first().m == ""
    assert spark.sql("SELECT text_length_arrow('four') AS n").first().n == 4
    joined = spark.sql("""SELECT v, word FROM VALUES ('a_b'), ('c') AS t(v)
                          LEFT JOIN LATERAL split_words(v) ON true""")
    assert rows_of(joined, "v", "word") == [("a_b", "a"), ("a_b", "b"), ("c", "c")]


def test_user_aggregate_skips_keys_taken_back_whole(spark):
    df = files.from_rows(spark, [("a", 1.0, 1), ("a", 3.0, 1), ("b", 5.0, 1), ("b", 5.0, -1)],
                         "k string, v double, sign int")
    got = udfs.aggregate_with(df, ["k"], "v", udfs.WeightedAverage(), sign="sign")
    assert rows_of(got, "k", "average") == [("a", 2.0)]


def test_top_values(spark):
    df = files.from_rows(spark, [("a", float(v)) for v in (5, 1, 9, 9, 2)], "k string, v double")
    got = udfs.aggregate_with(df.repartition(3), ["k"], "v", udfs.TopValues(3))
    assert rows_of(got, "rk", "value") == [(1, 9.0), (2, 9.0), (3, 5.0)]


def test_resource_per_task(spark):
    from tidemark.operators.rows import with_resource

    got = with_resource(
        spark.range(4), dict, lambda r, batch: batch.assign(id=batch["id"] * 2), lambda r: None, "id long")
    assert rows_of(got, "id") == [(0,), (2,), (4,), (6,)]


def test_spread(spark):
    from tidemark.operators.rows import spread

    df = spark.range(100)
    assert spread(df, "by_key", 3, "id").rdd.getNumPartitions() == 3
    assert spread(df, "round_robin", 5).rdd.getNumPartitions() == 5
    assert spread(df, "single", 1).rdd.getNumPartitions() == 1
    assert spread(df, "fewer", 2).rdd.getNumPartitions() == 2
    assert F.max("id") is not None
