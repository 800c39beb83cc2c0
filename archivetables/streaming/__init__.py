"""The crawl log while the crawl still writes it, as Structured Streaming.

``crawl_status`` and ``crawl_fatal`` are plain projections and filters, and work on these
streams as they are.
"""

from archivetables.streaming.crawl_log import read_crawl_log_stream, stop_on_fatal

__all__ = ["read_crawl_log_stream", "stop_on_fatal"]
