"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow import schemas as S
from gaugeflow import session
from gaugeflow.functions import readings, records, sql
from gaugeflow.operators import decode, evaluate, features, synth
from gaugeflow.operators import model as models
from gaugeflow.plans import event_records as er
from gaugeflow.plans import jobs, topic_queries
from gaugeflow.plans.fixed_model import FIXED
from gaugeflow.sources import documents, endpoint_config
from gaugeflow.sources.messages import FROM_EARLIEST, FROM_LATEST, Subscription
from gaugeflow.streaming import runs, sinks

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = endpoint_config.packaged_config()
FAMILIES = endpoint_config.packaged_config("sensor_families.json")
ARCHIVED = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def _records(spark: SparkSession, sf_dir: str, noise: bool = False, coded: bool = False):
    return er.event_records(er.events(spark, sf_dir), CONFIG, noise, coded)


def _messages(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return er.event_messages(er.events(spark, sf_dir), CONFIG, **how)


def _message_stream(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return er.event_messages(er.event_stream(spark, sf_dir), CONFIG, **how)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir, noise=True, coded=True)
    return decode.rename_label(rows)


def _through_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream into a new table and read that table."""
    spark = stream.sparkSession
    folder = session.work_folder(spark, purpose)
    runs.run_available(sinks.to_table(stream, f"{folder}/table", f"{folder}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


# Sources


def stream_subscribe(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _message_stream(spark, sf_dir).where(Subscription((er.TOPIC_NAME,)).selected())
    return _through_table(decode.cast_envelope(chosen), "subscribe")


def stream_topic_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _message_stream(spark, sf_dir, topic=F.col("event_type"))
    chosen = stream.where(Subscription(("click", "view")).selected())
    return _through_table(decode.cast_envelope(chosen), "topic-set")


def offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = {er.TOPIC_NAME: {0: FROM_EARLIEST, 1: 100, 2: 7, 3: FROM_LATEST}}
    subscription = Subscription((er.TOPIC_NAME,), start=start)
    return decode.cast_envelope(_messages(spark, sf_dir).where(subscription.selected()))


def resume_no_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.work_folder(spark, "resume")
    sink = sinks.TableSink(f"{folder}/archive")
    for _ in range(2):
        writer = jobs.archive(_message_stream(spark, sf_dir), sink, f"{folder}/checkpoint")
        runs.run_available(writer)
    return sink.read(spark, ARCHIVED).select("key", *decode.POSITION)


def collection_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{session.work_folder(spark, 'collection')}/documents"
    _messages(spark, sf_dir).select(records.text("value")).write.text(path)
    return decode.flatten(documents.scan_collection(spark, "json", path, S.NAMED_RECORD))


def config_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured levels, and how many records of each label have them."""
    config = endpoint_config.config_from_text(spark, endpoint_config.packaged_text())
    seen = _records(spark, sf_dir).unpivot(S.RESULT, S.CATEGORIES, "category", "level")
    counts = seen.groupBy("category", "level").agg(
        F.count_if(F.col(S.RESULT) == 1).alias("n_one"),
        F.count_if(F.col(S.RESULT) == 0).alias("n_zero"),
    )
    joined = endpoint_config.level_table(config).join(counts, ["category", "level"], "left")
    return joined.na.fill(0, ["n_one", "n_zero"])


def config_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured sensors, and the readings of each."""
    config = endpoint_config.config_from_text(spark, endpoint_config.packaged_text())
    seen = _records(spark, sf_dir).unpivot([], S.SENSORS, "name", "reading")
    measured = seen.groupBy("name").agg(
        F.count("reading").alias("n_readings"),
        F.min("reading").alias("min_reading"),
        F.max("reading").alias("max_reading"),
        F.round(F.avg("reading"), 6).alias("mean_reading"),
    )
    moments = ["scale", "oneMean", "oneStdDev", "zeroMean", "zeroStdDev"]
    sensors = endpoint_config.sensor_table(config)
    return sensors.select("sensor_no", "name", "simulatorType", *moments).join(
        measured, "name", "left"
    )


# Sinks


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{session.work_folder(spark, 'publish')}/messages"
    messages = _messages(spark, sf_dir, topic=F.col("event_type"))
    # In two calls, each of which adds to what is there.
    for half in (0, 1):
        jobs.publish(messages.where(F.col("offset") % 2 == half), "parquet", path)
    return spark.read.schema(S.ENVELOPE).parquet(path)


def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_back = _published(spark, sf_dir)
    return read_back.select("topic", records.text("key"), records.text("value"))


def delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_back = decode.cast_envelope(_published(spark, sf_dir))
    return read_back.select("key", records.delivery_line().alias("line"))


def archive_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.work_folder(spark, "archive")
    sink = sinks.TableSink(f"{folder}/archive", partition_by=("status",))
    stream = er.damage(_message_stream(spark, sf_dir))
    runs.run_available(jobs.archive(stream, sink, f"{folder}/checkpoint"))
    return sink.read(spark, ARCHIVED).select("_id", "key", "status", "value")


def train_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages archived as nested documents, read back, and made ready for training."""
    folder = session.work_folder(spark, "documents")
    sink = sinks.TableSink(f"{folder}/archive", fmt="json", partition_by=("status",))
    stream = er.damage(_message_stream(spark, sf_dir))
    runs.run_available(jobs.archive_documents(stream, sink, f"{folder}/checkpoint"))
    own = [T.StructField(name, T.StringType()) for name in ("_id", "status")]
    stored = T.StructType([*own, *S.NAMED_RECORD.fields])
    archived = documents.scan_collection(spark, "json", f"{folder}/archive", stored)
    return jobs.prepare(archived, CONFIG)


def archive_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.work_folder(spark, "batched")
    sink = sinks.TableSink(f"{folder}/archive")
    writer = sinks.to_sink(
        decode.archive_rows(_message_stream(spark, sf_dir)),
        sink,
        f"{folder}/checkpoint",
        lambda batch: batch.withColumn("insert_no", sinks.insert_number()),
    )
    runs.run_available(writer)
    return sink.read(spark, ARCHIVED).select("_id", "key", "value")


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.work_folder(spark, "fan-out")
    console, store = (sinks.TableSink(f"{folder}/{name}") for name in ("console", "store"))
    stream = _message_stream(spark, sf_dir)
    runs.run_available(jobs.consume(stream, console, store, f"{folder}/checkpoint"))
    lines = T.StructType([T.StructField("key", T.StringType()), T.StructField("line", T.StringType())])
    printed = console.read(spark, lines).select(F.lit("console").alias("sink"), "key", "line")
    stored = store.read(spark, ARCHIVED).select(
        F.lit("store").alias("sink"), "key", F.col("value").alias("line")
    )
    return printed.unionByName(stored)


def record_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.cast_envelope(_messages(spark, sf_dir)).select(
        "key",
        records.consumed_line().alias("consumed"),
        records.archived_line().alias("archived"),
    )


def _scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = session.work_folder(spark, "score")
    stream = _message_stream(spark, sf_dir, noise=True)
    path, checkpoint = f"{folder}/scored", f"{folder}/checkpoint"
    runs.run_available(jobs.score(stream, FIXED, CONFIG, path, checkpoint))
    return spark.read.parquet(path)


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.array(*[F.col(name).cast("double") for name in S.FEATURES])
    return _scored_table(spark, sf_dir).select(
        S.TIME, "label", "prediction", records.scored_line(values).alias("line")
    )


# Decoding


def envelope_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.cast_envelope(_messages(spark, sf_dir)).select("key", "value")


def _decoded(spark: SparkSession, sf_dir: str, schema: T.StructType, **how) -> DataFrame:
    text = decode.cast_envelope(_messages(spark, sf_dir, **how))
    return decode.decode_values(text, schema)


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(spark, sf_dir, S.CODED_RECORD, coded=True)
    return decoded.select(
        "key",
        F.col(f"data.{S.TIME}"),
        F.col(f"data.{S.TOPIC}"),
        F.col(f"data.{S.RESULT}"),
        f"data.{S.CATEGORY_GROUP}.*",
        f"data.{S.SENSOR_GROUP}.*",
    )


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = er.damage(_messages(spark, sf_dir))
    return decode.decode_messages(messages, CONFIG).select("key", "status")


def document_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = records.document_field(F.col("props"), "$.k", "int")
    return er.events(spark, sf_dir).select("event_id", field.alias("k"))


def nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = decode.extract(_decoded(spark, sf_dir, S.NAMED_RECORD))
    return extracted.select(
        S.TIME,
        S.TOPIC,
        S.RESULT,
        F.col(f"{S.CATEGORY_GROUP}.cat1"),
        F.col(f"{S.SENSOR_GROUP}.sensor9"),
    )


def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.flatten(decode.extract(_decoded(spark, sf_dir, S.NAMED_RECORD)))


def drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = decode.flatten(_decoded(spark, sf_dir, S.NAMED_RECORD), "key", record="data")
    return decode.rename_label(flat.drop(*S.FEATURES))


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir, coded=True).select(records.text("key"), records.text("value"))


def time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.events(spark, sf_dir).select(
        "event_id",
        records.time_text(F.col("ts")).alias("time"),
        records.wall_time_text(F.col("ts")).alias("wall_time"),
    )


def group_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = _records(spark, sf_dir).select(
        "event_id",
        F.expr(records.group_by_name(S.CATEGORIES)).alias("c"),
        F.expr(records.group_by_name(S.SENSORS)).alias("s"),
    )
    return grouped.select(
        "event_id",
        F.size("c").alias("n_categories"),
        F.size("s").alias("n_sensors"),
        *[F.col(f"c.{name}") for name in S.CATEGORIES],
        *[F.col(f"s.{name}") for name in S.SENSORS],
    )


def encode_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _records(spark, sf_dir).select("event_id", *S.CATEGORIES)
    return decode.encode_levels(named, CONFIG)


# Features and model


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Level numbers of simulated records are never missing, so no row needs a check.
    assembled = features.assemble(_labelled(spark, sf_dir), handle_invalid="error")
    values = assembled.select("event_id", "label", vector_to_array("features").alias("v"))
    members = [F.get("v", i).alias(f"f{i}") for i in range(len(S.FEATURES))]
    return values.select("event_id", "label", *members)


def random_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts together hold every row once, by count and by a sum of hashes."""
    rows = er.events(spark, sf_dir).select("event_id")
    train, test = features.random_split(rows)
    tagged = {"all": rows, "train": train, "test": test}
    sums = None
    for name, part in tagged.items():
        total = part.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("event_id").cast("decimal(20,0)")).alias("h"),
        ).withColumn("part", F.lit(name))
        sums = total if sums is None else sums.unionByName(total)

    def of(name: str, column: str):
        return F.sum(F.when(F.col("part") == name, F.col(column)))

    row = sums.agg(
        of("all", "n").alias("n_rows"),
        (of("train", "n") + of("test", "n")).alias("n_split"),
        (of("train", "h") + of("test", "h") == of("all", "h")).alias("same_rows"),
        F.abs(of("train", "n") / of("all", "n") - 0.8).alias("off"),
    )
    return row.select("n_rows", "n_split", "same_rows", (F.col("off") < 0.05).alias("share_ok"))


def key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = features.split_part(F.col("event_id"))
    return er.events(spark, sf_dir).select("event_id", part.alias("part"))


def _trained(spark: SparkSession, sf_dir: str) -> tuple[jobs.Trained, str]:
    part = features.split_part(F.col("event_id")).alias("part")
    prepared = _labelled(spark, sf_dir).select(
        records.wall_time_text(F.col("ts")).alias(S.TIME), "label", *S.FEATURES, part
    )
    path = f"{session.work_folder(spark, 'model')}/model"
    return jobs.train(prepared, path, measured=False), path


def lr_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, _ = _trained(spark, sf_dir)
    # Any solver comes near the one minimum; two digits are the same in all of them.
    rounded = F.round("coefficient", 2) + 0
    return models.coefficient_table(spark, trained.model).withColumn("coefficient", rounded)


def lr_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the trained model is the one with the smallest loss, by the training rows."""
    trained, _ = _trained(spark, sf_dir)
    rows = _labelled(spark, sf_dir).where(features.split_part(F.col("event_id")) == "train")
    coefficients = [float(c) for c in trained.model.coefficients]
    told = models.optimality(rows, coefficients, float(trained.model.intercept))
    return told.select("feature", "sign", "optimal", F.round("loss", 6).alias("loss"))


def reload_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained, path = _trained(spark, sf_dir)
    return models.parity(trained.test, trained.model, models.load(path))


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FIXED.score(_labelled(spark, sf_dir)).select(
        F.col("event_id").cast("string").alias("key"),
        "label",
        F.round("margin", 6).alias("margin"),
        F.round("probability", 6).alias("probability"),
        "prediction",
    )


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_table(spark, sf_dir).select(
        "key",
        "label",
        F.round("margin", 6).alias("margin"),
        F.round("probability", 6).alias("probability"),
        "prediction",
        "status",
    )


def hard_label_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = evaluate.hard_label_auc(FIXED.score(_labelled(spark, sf_dir)))
    return measured.withColumn("auc", F.round("auc", 9))


def score_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = evaluate.score_auc(FIXED.score(_labelled(spark, sf_dir)), "margin")
    return measured.withColumn("auc", F.round("auc", 9))


# Generation


def gen_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = readings.drawn_label(er.EventDraws().uniform(0), CONFIG.success_rate)
    return er.events(spark, sf_dir).selectExpr("event_id", sql.named(label, "label"))


def gen_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of all sensor families, and of one that does not exist."""
    draws = er.EventDraws()
    label = readings.drawn_label(draws.uniform(0), FAMILIES.success_rate)
    labelled = er.events(spark, sf_dir).selectExpr("*", sql.named(label, "label"))
    drawn = [
        readings.raw_reading(s, "label", draws.normal(9 + i), draws.uniform(9 + i))
        for i, s in enumerate(FAMILIES.sensors)
    ]
    return labelled.selectExpr(
        "event_id",
        "label",
        *[sql.named(f"round({raw}, 9)", s.name) for raw, s in zip(drawn, FAMILIES.sensors)],
    )


def quantise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive and negative values, with halves among the thousandths."""
    return er.events(spark, sf_dir).selectExpr(
        "event_id",
        sql.named(readings.thousandths("(value - 20D)", 0.025), "fine"),
        sql.named(readings.quantise("(value - 20D)", 2.5), "coarse"),
    )


def threshold_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("event_id", S.RESULT, *S.CATEGORIES)


def noisy_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, noise=True).select("event_id", *S.CATEGORIES)


def gen_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    simulated = synth.simulate(er.events(spark, sf_dir), CONFIG, er.EventDraws())
    time = records.wall_time_text(F.col("ts"))
    return synth.to_messages(simulated, CONFIG, F.col("event_id"), time, F.lit(er.TOPIC_NAME))


def mode_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages through both modes: how many rows each wrote, by status."""
    counts = None
    for mode in ("archive", "score"):
        folder = session.work_folder(spark, f"mode-{mode}")
        stream = er.damage(_message_stream(spark, sf_dir))
        path, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
        runs.run_available(jobs.run(mode, stream, CONFIG, path, checkpoint, FIXED))
        fields = [T.StructField(n, T.StringType()) for n in ("key", "status")]
        if mode == "archive":
            fields.append(T.StructField("batch", T.LongType()))
        rows = spark.read.schema(T.StructType(fields)).parquet(path)
        counted = rows.groupBy("status").agg(F.count("key").alias("n")).withColumn(
            "mode", F.lit(mode)
        )
        counts = counted if counts is None else counts.unionByName(counted)
    return counts


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        stream_subscribe,
        stream_topic_set,
        offset_range,
        resume_no_dup,
        collection_scan,
        config_levels,
        config_sensors,
        publish_envelope,
        delivery_report,
        archive_append,
        train_documents,
        archive_batched,
        fan_out,
        record_line,
        scored_rows,
        envelope_cast,
        json_decode,
        json_rejects,
        document_field,
        nested_extract,
        struct_flatten,
        drop_rename,
        json_encode,
        time_text,
        group_readings,
        encode_levels,
        assemble_features,
        random_split_counts,
        key_split,
        lr_coefficients,
        lr_optimality,
        reload_parity,
        score_batch,
        score_stream,
        hard_label_auc,
        score_auc,
        gen_label,
        gen_reading,
        quantise,
        threshold_level,
        noisy_level,
        gen_records,
        mode_switch,
    )
} | topic_queries.QUERIES


def tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(session.tune(spark), sf_dir)

    run.__name__ = query.__name__
    return run
