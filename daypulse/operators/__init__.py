"""DataFrame -> DataFrame operators. Each runs on batch and streaming frames
alike where Spark allows, and none collects to the driver."""
