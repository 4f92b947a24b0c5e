"""Readers and writers: schema files, reference tables, measure results."""
