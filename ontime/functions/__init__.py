from ontime.functions.argmax import argmax_name, delay_code, sum_of  # noqa: F401
from ontime.functions.buckets import DELAY_SPLITS, bucketize  # noqa: F401
from ontime.functions.columns import (  # noqa: F401
    drop_matching,
    matching_columns,
    non_string_columns,
    numeric_columns,
    resolve_column,
    select_matching,
)
from ontime.functions.keys import fraction_threshold, hash_key  # noqa: F401
from ontime.functions.labels import (  # noqa: F401
    CANCELLATION_LABELS,
    CAUSE_NAMES,
    DELAY_BUCKET_LABELS,
    label_lookup,
)
from ontime.functions.timefns import add_minutes, hhmm_timestamp, local_to_utc  # noqa: F401
