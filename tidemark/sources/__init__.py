"""Readers and writers: table sets, change streams, relational databases, the driver's tables."""
