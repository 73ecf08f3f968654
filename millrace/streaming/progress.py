"""What a running query has read and keeps."""

from pyspark.sql.streaming import StreamingQuery


def end_positions(query: StreamingQuery) -> list:
    """The end position of each source after the last batch, as the source
    tells it: offsets per partition for Kafka."""
    progress = query.lastProgress
    return [source["endOffset"] for source in progress["sources"]] if progress else []


def rates(query: StreamingQuery) -> dict:
    """Rows read, rows per second and rows of state of the last batch."""
    progress = query.lastProgress
    if not progress:
        return {}
    return {
        "input_rows": progress["numInputRows"],
        "rows_per_second": progress["processedRowsPerSecond"],
        "state_rows": sum(s["numRowsTotal"] for s in progress["stateOperators"]),
    }
