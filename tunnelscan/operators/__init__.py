"""DataFrame -> DataFrame steps of the training and scoring jobs."""

from tunnelscan.operators.domains import (  # noqa: F401
    default_suffix_rules,
    drop_reverse_lookups,
    read_suffix_rules,
    registrable_domain,
)
from tunnelscan.operators.features import generate_features  # noqa: F401
from tunnelscan.operators.gate import busy_groups, group_counts, volume_gate  # noqa: F401
from tunnelscan.operators.joins import materialise, sized  # noqa: F401
from tunnelscan.operators.verdict import (  # noqa: F401
    alerting_groups,
    group_stats,
    interval_stats,
    join_alerts,
    suspicious_keys,
    suspicious_rows,
    with_alert_id,
    with_indicators,
    with_label_str,
)
