"""Incremental maintenance of the materialised daily summary."""
