"""Structured Streaming jobs (T1-T5) built on the batch operators.

Every query runs with a checkpoint location (offsets and commits survive a
restart) and a ``foreachBatch`` sink that is idempotent per ``batch_id``, so
a replayed micro-batch after a failure does not change the result.
"""

from quayside.streaming.jobs import (  # noqa: F401
    read_change_stream,
    read_stream_state,
    run_stream,
    stream_apply_changes,
    stream_risk,
)
