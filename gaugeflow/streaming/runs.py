"""Run a stream until its source is read, for a bounded time, or until it is stopped."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds now, in as many batches as it asks for, and end."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_caught_up(writer: DataStreamWriter) -> StreamingQuery:
    """Process what the source holds in batches as large as it allows, until it has no more, and end.

    For sources whose bound would end `run_available` after one batch.
    """
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def run_for(writer: DataStreamWriter, seconds: int) -> StreamingQuery:
    """Process what arrives within a number of seconds, then stop."""
    query = writer.start()
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()
    return query


def run_until_stopped(writer: DataStreamWriter, interval: str | None = None) -> StreamingQuery:
    """Process what arrives, every interval such as `30 seconds`, until the query is stopped.

    Without an interval the next batch starts as soon as the last one is done. Ends with an
    error if the query does.
    """
    if interval:
        writer = writer.trigger(processingTime=interval)
    query = writer.start()
    query.awaitTermination()
    return query
