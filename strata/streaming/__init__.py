"""Structured Streaming versions of the bronze/quarantine flow and of
change-event publish/apply."""
