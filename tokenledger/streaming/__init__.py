"""Streaming: intentionally empty.

The reference pipeline has no streaming source, watermark or event-time
window (every feed is a batch truncate-and-load), so there is no streaming
operator to rebuild.  All models here are batch DataFrame jobs.
"""
