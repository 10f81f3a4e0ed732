"""Streaming.

The specification format has no streams, windows over time or watermarks; nothing of that kind is
built. What does arrive continuously is the catalog's change stream, so ``changes`` applies it
as a streaming aggregation: the fold of each key is kept in Spark's state store.
"""
