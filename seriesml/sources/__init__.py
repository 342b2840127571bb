"""Readers, payload decoding and sinks."""
