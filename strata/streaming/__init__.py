from .feed_stream import feed_stream, merge_batch, start_merge_stream

__all__ = ["feed_stream", "merge_batch", "start_merge_stream"]
