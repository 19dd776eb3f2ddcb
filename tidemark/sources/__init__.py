"""Readers for files, line streams, brokers and generated rows."""
