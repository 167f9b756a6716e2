"""Composed plans: the named table catalog and the staged multi-table export."""
