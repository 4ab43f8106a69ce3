"""Structured Streaming forms of topic assignment and weekly counts."""
from .assign import assign_topics_stream, weekly_counts_stream  # noqa: F401
from .spikes import negative_spikes_stream  # noqa: F401
