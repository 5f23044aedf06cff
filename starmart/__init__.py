"""starmart: nested order snapshots -> checked star schema -> business queries, on Spark."""

__version__ = "0.1.0"
