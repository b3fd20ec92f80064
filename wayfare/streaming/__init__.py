"""Structured Streaming form of the word job.

The reference has no streaming; the word operators are plain DataFrame
transformations, so they run unchanged over a stream of text files.
"""

from wayfare.streaming.words import start_word_count, word_count_stream

__all__ = ["word_count_stream", "start_word_count"]
