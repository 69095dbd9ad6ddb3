"""Readers, schemas, sinks, durable intermediate tables."""
