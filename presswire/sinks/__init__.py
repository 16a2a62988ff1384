"""Stores and message sinks."""
