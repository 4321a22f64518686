"""The scoring and confusion-count operators over a Structured Streaming source."""

from pulsegrid.streaming.scoring import (
    run_to_table,
    running_confusion,
    running_confusion_scored,
    start_running_confusion,
    stream_table,
)

__all__ = ["run_to_table", "running_confusion", "running_confusion_scored",
           "start_running_confusion", "stream_table"]
