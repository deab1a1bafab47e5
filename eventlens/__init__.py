"""eventlens: event-time analytics on Spark DataFrames.

Batch operators live in ``eventlens.operators``; Structured Streaming
counterparts in ``eventlens.streaming``; sources, parsers and sinks in
``eventlens.sources``; column helpers in ``eventlens.functions``; named
end-to-end plans in ``eventlens.plans``.
"""

__version__ = "0.1.0"
