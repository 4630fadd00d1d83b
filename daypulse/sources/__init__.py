"""Sources: supplied tables, Kafka-shaped record streams, file stream twins."""
