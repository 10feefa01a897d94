"""Small hand-made fixtures for unit tests (the registered queries use the driver's tables)."""

import json

SENTINEL = -4852116231933722724


def envelope(op, table, ts_ns, before=None, after=None, schema="dbo"):
    payload = {"op": op, "source": {"schema": schema, "table": table, "ts_ns": ts_ns},
               "before": json.loads(before) if isinstance(before, str) else before,
               "after": json.loads(after) if isinstance(after, str) else after}
    return json.dumps({"payload": payload})


def raw_rows(values, topic="t"):
    """(topic, partition, offset, key, value, timestamp) rows from envelope strings (None = tombstone)."""
    import datetime
    return [(topic, 0, i, None, None if v is None else bytearray(v.encode()), datetime.datetime(2024, 1, 1))
            for i, v in enumerate(values)]


RAW_SCHEMA = "topic STRING, partition INT, offset BIGINT, key BINARY, value BINARY, timestamp TIMESTAMP"
