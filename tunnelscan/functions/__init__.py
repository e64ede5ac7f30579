"""Column expressions (JVM-side; no row-at-a-time Python)."""

from tunnelscan.functions.lexical import (  # noqa: F401
    answer_array,
    answer_features,
    digit_count,
    entropy,
    name_features,
    subdomain,
    upper_count,
)
from tunnelscan.functions.labels import label_index, prediction_label  # noqa: F401
