"""The jobs: publish, consume, archive, score, train, and the switch between two of them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gaugeflow import schemas as S
from gaugeflow import session
from gaugeflow.functions import records
from gaugeflow.operators import decode, evaluate, features
from gaugeflow.operators import model as models
from gaugeflow.sources.endpoint_config import EndpointConfig
from gaugeflow.sources.topic_stream import NAME as TOPIC_TABLE
from gaugeflow.streaming import manifests, sinks, topics

SCORED = [S.TIME, "label", "margin", "probability", "prediction"]


def publish(
    messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options: str
) -> None:
    """Append `topic, key, value` messages; the topic column routes each row.

    A broker gives each message its place, and so does a topic table, from its ledger. In a plain
    table rows without a place get the number of their task and the next position after
    what that topic and partition hold, which is read for it; prefer a topic table.
    One publisher writes a table at a time.
    """
    if fmt == TOPIC_TABLE:
        topics.TopicTable(path).publish(messages)
        return
    if fmt == "kafka":
        messages.select("topic", "key", "value").write.format(fmt).options(**options).save()
        return
    placed = messages if "offset" in messages.columns else _placed(messages, fmt, path)
    writer = placed.write.format(fmt).mode("append").options(**options)
    writer.partitionBy("topic").save(path)


def _held(messages: DataFrame, fmt: str, path: str) -> DataFrame | None:
    """The next free position of each topic and partition of a table; None if there is no table."""
    try:
        there = messages.sparkSession.read.schema(S.ENVELOPE).format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return there.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("held"))


def _placed(messages: DataFrame, fmt: str, path: str) -> DataFrame:
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.spark_partition_id().alias("partition"),
        position.alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    held = _held(messages, fmt, path)
    if held is None:
        return placed
    after = (F.col("offset") + F.coalesce("held", F.lit(0))).alias("offset")
    return placed.join(held, ["topic", "partition"], "left").select(
        *[after if name == "offset" else name for name in placed.columns]
    )


def consume(
    messages: DataFrame, printed: sinks.Sink, store: sinks.Sink, checkpoint: str
) -> DataStreamWriter:
    """Every message as a printed line and as an archived document."""

    def lines(batch: DataFrame) -> DataFrame:
        return batch.select("key", records.consumed_line().alias("line"))

    branches = {
        "lines": sinks.Branch(lines, printed),
        "store": sinks.Branch(lambda batch: batch, store),
    }
    return sinks.fan_out(decode.archive_rows(messages), branches, checkpoint)


def publish_stream(
    messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataStreamWriter:
    """Publish a stream of `topic, key, value`, into a topic table each message once."""
    if fmt == TOPIC_TABLE:
        # The checkpoint tells the batches of one query from those of another.
        return topics.publish_stream(messages, topics.TopicTable(path), checkpoint, writer=checkpoint)
    writer = messages.select("topic", "key", "value").writeStream.format(fmt).options(**options)
    return writer.option("checkpointLocation", checkpoint)


def consume_whole(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """As `consume`, into a table whose lines and documents of a batch appear together."""
    shapes = {
        "lines": lambda batch: batch.select("key", records.consumed_line().alias("line")),
        "documents": lambda batch: batch,
    }
    return manifests.fan_out_whole(decode.archive_rows(messages), shapes, manifests.WholeBatches(path), checkpoint)


def archive(messages: DataFrame, sink: sinks.Sink, checkpoint: str) -> DataStreamWriter:
    """Every message as a document, marked where its text is none."""
    return sinks.to_sink(decode.archive_rows(messages), sink, checkpoint)


def archive_documents(messages: DataFrame, sink: sinks.Sink, checkpoint: str) -> DataStreamWriter:
    """Every message as a nested document, which a store can query and training can read."""
    return sinks.to_sink(decode.document_rows(messages), sink, checkpoint)


def scored_messages(
    messages: DataFrame, score: models.LinearScore, config: EndpointConfig
) -> DataFrame:
    """Every message with its score, or with the reason why it has none.

    One projection chain without a shuffle, the same for a table and a stream.
    The text is kept for messages that were not scored, and only for those.
    """
    decoded = decode.decode_messages(messages, config)
    scored = score.score(decoded)
    unusable = F.col("status") != decode.OK
    blanked = {
        name: F.when(~unusable, F.col(name)) for name in ("margin", "probability", "prediction")
    }
    kept_text = F.when(unusable, F.col("value"))
    return scored.withColumns({**blanked, "value": kept_text}).select(
        "key", *decode.POSITION, *SCORED, *S.FEATURES, "status", "value"
    )


def score(
    messages: DataFrame,
    linear: models.LinearScore,
    config: EndpointConfig,
    path: str,
    checkpoint: str,
) -> DataStreamWriter:
    """Score a stream into a table partitioned by status."""
    return sinks.to_table(scored_messages(messages, linear, config), path, checkpoint, "status")


def run(
    mode: str,
    messages: DataFrame,
    config: EndpointConfig,
    path: str,
    checkpoint: str,
    linear: models.LinearScore | None = None,
) -> DataStreamWriter:
    """Score or archive, as the mode says; both write a table partitioned by status."""
    if mode == "score":
        if linear is None:
            raise ValueError("scoring needs a model")
        return score(messages, linear, config, path, checkpoint)
    if mode == "archive":
        return archive(messages, sinks.TableSink(path, partition_by=("status",)), checkpoint)
    raise ValueError(f"mode is score or archive, not {mode}")


@dataclass(frozen=True)
class Trained:
    model: LogisticRegressionModel
    metrics: Mapping[str, float]
    train: DataFrame
    test: DataFrame


def prepare(documents: DataFrame, config: EndpointConfig) -> DataFrame:
    """Archived documents as rows to train on, each with its part.

    They are nested documents with an identity `_id`, or messages with their text. Documents that cannot be used are left out here; they stay in the archive. An
    archive says which ones, so the others are not even read.
    """
    if "status" in documents.columns:
        documents = documents.where(F.col("status") == decode.OK)
    if S.CATEGORY_GROUP in documents.columns:
        usable, identity = decode.usable_documents(documents, config), F.col("_id")
    else:
        usable = decode.accepted(decode.decode_messages(documents, config))
        identity = F.concat_ws("-", *decode.POSITION)
    return usable.select(S.TIME, "label", *S.FEATURES, features.split_part(identity).alias("part"))


def train(
    prepared: DataFrame,
    model_path: str,
    training: models.Training = models.Training(),
    measured: bool = True,
) -> Trained:
    """Train on part `train`, evaluate on part `test` if asked for, save the model.

    Training reads its rows more than once. They are written once, as numbers
    and by part, so neither documents nor the other part are read again.
    """
    staged = session.stage(prepared, "prepared", "part")
    train_rows, test_rows = (
        features.assemble(staged.where(F.col("part") == part).drop("part"))
        for part in ("train", "test")
    )
    model = models.fit(train_rows, training)
    metrics = {}
    if measured:
        predictions = model.transform(test_rows)
        metrics["auc_of_predictions"] = evaluate.hard_label_auc(predictions).first()["auc"]
        metrics["auc_of_scores"] = evaluate.evaluator_auc(predictions)
    # Last, so that a model which cannot be evaluated replaces none.
    models.save(model, model_path)
    return Trained(model, metrics, train_rows, test_rows)
