from eventlens.streaming.joins import stream_interval_join, stream_reconcile  # noqa: F401
from eventlens.streaming.runner import run_to_memory, run_to_parquet  # noqa: F401
from eventlens.streaming.stateful import (  # noqa: F401
    replay,
    stream_capped_window_counts, stream_click_cap, stream_consecutive_pairs, stream_fail_bursts, stream_followed_by,
    stream_match_outcomes,
)
from eventlens.streaming.windows import (  # noqa: F401
    lateness_delay, start_stream_topn, stream_window_counts, stream_window_distinct, watermarked,
)
