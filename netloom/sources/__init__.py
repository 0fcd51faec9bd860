"""Readers, decoders and writers."""
