"""Recurring intake as Structured Streaming."""
