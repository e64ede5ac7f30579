"""Readers and writers: O-01..O-07, O-59."""

from tunnelscan.sources.readers import (  # noqa: F401
    load_config,
    read_dns_log,
    read_training_sample,
)
from tunnelscan.sources.sinks import (  # noqa: F401
    kafka_records,
    write_alerts,
    write_messages,
    write_to_kafka,
)
