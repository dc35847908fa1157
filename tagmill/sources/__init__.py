"""Readers and writers. Schemas are explicit everywhere."""
