"""Streaming jobs: sessions, folders, sinks and stateful steps."""
