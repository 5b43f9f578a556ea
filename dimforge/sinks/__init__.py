"""Sinks: idempotent partition publishing and input-completeness checks."""
