"""Messages for stream tests: small frames written as files, one file a call."""

import datetime as dt
import json

from millrace.schemas import MESSAGE


class Topic:
    def __init__(self, spark, path, name="t"):
        self.spark, self.path, self.name, self.next = spark, path, name, 0

    def send(self, values, at="2024-01-01 00:00:00", topic=None):
        """Append one file with these values (JSON objects or raw text)."""
        rows = []
        for value in values:
            text = value if isinstance(value, str) or value is None else json.dumps(value)
            moment = dt.datetime.fromisoformat(at)
            rows.append((topic or self.name, 0, self.next, moment, None, text))
            self.next += 1
        frame = self.spark.createDataFrame(rows, MESSAGE).coalesce(1)
        frame.write.mode("append").parquet(self.path)


def finish(queries):
    """Let every query work off what there is, and pass on its failure."""
    for query in queries:
        query.awaitTermination()
        if query.exception():
            raise query.exception()
