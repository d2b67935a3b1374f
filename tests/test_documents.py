"""Nested documents: what a store gets, and training from it."""

from pyspark.sql import functions as F

from gaugeflow.operators import decode
from gaugeflow.plans import jobs
from gaugeflow.sources import documents as scan
from gaugeflow.streaming import runs, sinks
from tests.sample import messages, text


def test_documents_hold_the_record_and_bad_texts_stay(spark):
    rows = decode.document_rows(messages(spark, [text(), "x", None, "[1]"])).orderBy("_id").collect()
    assert [r.status for r in rows] == ["ok", "malformed", "blank", "not_object"]
    assert [r.value for r in rows] == [None, "x", None, "[1]"]
    assert rows[0].Categories.cat0 is not None and rows[0].Sensors.sensor9 is not None
    assert all(r.Categories is None for r in rows[1:])


def test_documents_and_messages_prepare_alike(spark, config):
    values = [text(), text(Result=0), text(cat0="?"), text(Result=7), "x", text() + text(), None]
    from_text = jobs.prepare(messages(spark, values), config)
    from_documents = jobs.prepare(decode.document_rows(messages(spark, values)), config)
    assert from_documents.schema.names == from_text.schema.names
    assert sorted(from_documents.collect()) == sorted(from_text.collect())
    assert from_text.count() == 2


def test_an_empty_collection_prepares_no_rows(spark, config):
    documents = decode.document_rows(messages(spark, [text()])).where(F.lit(False))
    assert jobs.prepare(documents, config).count() == 0


def test_fan_out_leaves_no_batch_behind_and_keeps_every_row(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path)
    messages(spark, [text() for _ in range(50)]).write.parquet(str(source))
    stream = spark.readStream.schema(spark.read.parquet(str(source)).schema).parquet(str(source))
    lines, store = sinks.TableSink(f"{path}/lines", "json"), sinks.TableSink(f"{path}/store")
    runs.run_available(jobs.consume(stream, lines, store, f"{path}/checkpoint"))
    assert spark.read.json(f"{path}/lines").count() == spark.read.parquet(f"{path}/store").count() == 50


def test_a_stream_runs_until_it_is_stopped(spark, tmp_path):
    stream = spark.readStream.format("rate").load()
    seen = []

    def write(batch, batch_id):
        seen.append(batch_id)
        if len(seen) == 3:
            for query in spark.streams.active:
                query.stop()

    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(write)
    query = runs.run_until_stopped(writer, "1 second")
    assert not query.isActive and len(seen) == 3


MIXED = [
    '{"a":1,"b":{"x":1.5,"y z":"s","VOID":1,"OBJECT<":2},"c":[1,2],"n":null,"m":1,"big":12345678901234567890123}',
    '{"a":2.5,"b":{"x":3e5,"q":true},"c":["s"],"m":"t","d":"2020-01-01"}',
    '{"k`t":1,"o":[{"a":1},{"b":2.5}],"e":{}}',
    "12", "not json", '{"cut":', None,
]


def test_schema_of_mixed_documents(spark):
    texts = spark.createDataFrame([(t,) for t in MIXED], "value string").repartition(3)
    kinds = {f.name: f.dataType.simpleString() for f in scan.infer_schema(texts)}
    assert kinds == {
        "a": "double", "b": "struct<OBJECT<:bigint,VOID:bigint,q:boolean,x:double,y z:string>",
        "big": "decimal(23,0)", "c": "array<variant>", "d": "string", "e": "struct<>", "k`t": "bigint",
        "m": "variant", "n": "string", "o": "array<struct<a:bigint,b:double>>",
    }


def test_mixed_documents_as_columns(spark):
    texts = spark.createDataFrame([(t,) for t in MIXED], "value string").coalesce(1)
    read = scan.document_columns(texts, scan.infer_schema(texts))
    rows = read.select("a", F.col("b.x"), F.to_json("m").alias("m"), F.to_json("c").alias("c"), "big", "d")
    got = [tuple(r) for r in rows.collect()]
    assert got[0][:4] == (1.0, 1.5, "1", "[1,2]") and str(got[0][4]) == "12345678901234567890123"
    assert got[1] == (2.5, 300000.0, '"t"', '["s"]', None, "2020-01-01")
    assert got[3:] == [(None,) * 6] * 4 and len(got) == len(MIXED)


def test_no_documents_have_no_schema(spark):
    texts = spark.createDataFrame([("1",), (None,)], "value string")
    assert scan.infer_schema(texts).fields == []
    assert scan.infer_schema(texts.limit(0)).fields == []
    assert scan.document_columns(texts, scan.infer_schema(texts)).columns == []


def test_a_schema_is_inferred_in_one_pass(spark, tmp_path, plan_of):
    """One scan and one aggregation without a sort; the merge happens before rows are moved."""
    spark.createDataFrame([(t,) for t in MIXED[:3]], "value string").write.text(str(tmp_path / "d"))
    read = F.try_parse_json("value")
    plan = plan_of(spark.read.text(str(tmp_path / "d")).agg(F.schema_of_variant_agg(read)))
    assert plan.count("Scan text") <= 2 and "partial_schema_of_variant_agg" in plan
    assert scan.scan_documents(spark, str(tmp_path / "d")).count() == 3
