"""Readers: files and object storage, JDBC, Kafka envelopes, paged REST, probes."""
