"""Runnable jobs over the given tables: `python -m jobs.leak_safe_split`, `python -m jobs.arrivals`."""
