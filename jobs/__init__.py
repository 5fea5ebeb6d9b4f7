"""Runnable jobs over the library: see README.md, "Jobs"."""
