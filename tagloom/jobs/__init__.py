"""Runnable jobs: ``python -m tagloom.jobs.<name> --help``."""
