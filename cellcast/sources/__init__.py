"""Readers, writers, name parsing and missing-value normalisation."""
