"""Retail analytics on Spark: curated tables, star schema, marts, queries."""

from tillwright.session import build_session, run_dir, shared_dir

__all__ = ["build_session", "run_dir", "shared_dir"]
