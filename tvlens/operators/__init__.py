"""Reusable table operators: joins, numbering, labels, row expansion, overlap."""
