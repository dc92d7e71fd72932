"""Plays arriving as files: the batch cleaning and scoring, unchanged, on a stream.

The reference has no streams.  What carries over is stateless: the cleaning
predicate and a fitted pipeline's ``transform`` are per-row, so Structured
Streaming runs them incrementally with no state store.  The sink is
append-only parquet with its checkpoint in the shared folder, so a restarted
query resumes exactly where it stopped.
"""

from playlab.streaming.plays_stream import clean_stream, read_plays_stream, score_stream, start_scoring

__all__ = ["read_plays_stream", "clean_stream", "score_stream", "start_scoring"]
