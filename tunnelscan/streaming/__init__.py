"""The scoring job run on hourly DNS partitions as they arrive."""

from tunnelscan.streaming.hourly import start_hourly_scoring  # noqa: F401
