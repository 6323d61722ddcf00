"""Structured Streaming jobs: sessions, hourly counts and plain landing."""

from .events import (LateRows, end_replay, in_event_time, land, replay, session_sink, session_stream, split_late,
                     stream_session, tumbling_counts, watch_progress, with_end)

__all__ = ["LateRows", "end_replay", "in_event_time", "land", "replay", "session_sink", "session_stream", "split_late",
           "stream_session", "tumbling_counts", "watch_progress", "with_end"]
