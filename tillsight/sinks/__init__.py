"""Distributed CSV / JSON writers and typed read-back."""
