"""Readers, writers, caches and model persistence."""
from .feedback import to_feedback, read_feedback_csv, require_min_docs  # noqa: F401
