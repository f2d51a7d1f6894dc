"""Clinical message analytics on Spark: ingest, model, operate, forecast, report."""

from wardflow.session import build_session

__all__ = ["build_session"]
