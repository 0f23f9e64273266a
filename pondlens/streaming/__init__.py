"""Streaming entry points (scoring of records arriving as files)."""
