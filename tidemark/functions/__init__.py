"""Column functions: time conversion and change-envelope parsing."""

from tidemark.functions.timeconv import (  # noqa: F401
    SENTINEL_NS, day_to_date, epoch_to_ts, is_open, ms_to_ts, ns_div, ns_to_ts, round_seconds_ns, ts_to_ns,
)
from tidemark.functions.envelope import (  # noqa: F401
    ENVELOPE_SCHEMA, add_event_time, add_key, parse_envelope, row_image,
)
