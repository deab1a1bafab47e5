from eventlens.sources.parsers import (  # noqa: F401
    parse_ad_clicks, parse_delimited, parse_logins, parse_orders, parse_receipts,
    parse_user_behavior, parse_web_log,
)
from eventlens.sources.sinks import console_sink, split_by_tag, start_tagged_stream  # noqa: F401
from eventlens.sources.tables import load_table, load_tables  # noqa: F401
from eventlens.sources.text import read_lines, read_lines_stream  # noqa: F401
