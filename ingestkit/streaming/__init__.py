"""Structured Streaming: file/Kafka streams into bronze, quarantine and silver."""
