from eventlens.functions.time import (  # noqa: F401
    add_duration, bucket_of, duration_us, epoch_micros, event_time, from_epoch_ms,
    from_epoch_s, parse_text_time, sub_duration, to_event_timestamp, utc_day,
)
from eventlens.functions.text import format_time, ranked_report, warning_text  # noqa: F401
