"""Page loads with Structured Streaming: incremental ingest, and regression events in event time."""
from perfwatch.streaming.ingest import GATE_METRICS, checkpoint_location, start_page_load_ingest
from perfwatch.streaming.regressions import start_regression_stream

__all__ = ["GATE_METRICS", "checkpoint_location", "start_page_load_ingest", "start_regression_stream"]
