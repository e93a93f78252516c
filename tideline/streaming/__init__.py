"""Streaming writers, change targets and the path conventions they share."""
