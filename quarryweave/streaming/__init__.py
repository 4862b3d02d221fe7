"""Structured Streaming counterparts of the batch operators."""

from quarryweave.streaming.manifests import ingest_manifest_stream
from quarryweave.streaming.quotas import quota_windows, quota_windows_stream, streaks_stream

__all__ = ["ingest_manifest_stream", "quota_windows", "quota_windows_stream", "streaks_stream"]
