from ontime.operators.aggregates import (  # noqa: F401
    conditional_sums,
    distinct_tuple_count,
    frequency,
    percent_of_group,
    share_of,
    unpivot,
)
from ontime.operators.joins import join_with_suffix, key_union, lookup  # noqa: F401
from ontime.operators.partitions import map_partitions  # noqa: F401
from ontime.operators.ranking import numbered_rows, running_total, stratified_sample, top_k_with_ties  # noqa: F401
from ontime.operators.setops import union_all  # noqa: F401
from ontime.operators.sizing import bounded_broadcast, row_count_at_most  # noqa: F401
from ontime.operators.skew import frequent_keys, salted_join  # noqa: F401
from ontime.operators.windows import tumbling_count  # noqa: F401
