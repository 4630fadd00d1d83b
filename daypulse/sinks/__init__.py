"""Sinks: file twins of the Kafka and search sinks, keyed overwrite writers."""
