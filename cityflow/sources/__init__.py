"""Readers, writers and the adapter from the benchmark tables to the raw record shapes."""
