"""Structured Streaming forms of the rules, the consumer and the write path."""
