from eventlens.operators.joins import interval_join, reconcile  # noqa: F401
from eventlens.operators.limits import capped_window_counts, click_cap  # noqa: F401
from eventlens.operators.patterns import (  # noqa: F401
    consecutive_pairs, fail_bursts, followed_by, match_outcomes,
)
from eventlens.operators.sequence import ordered_context  # noqa: F401
from eventlens.operators.topn import hot_keys, top_n_per_group, top_n_per_window, window_report  # noqa: F401
from eventlens.operators.windows import (  # noqa: F401
    window_agg, window_counts, window_distinct, window_sum,
)
