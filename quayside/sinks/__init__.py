"""Writers: date-partitioned text, lake tables, topics, and the keyed document index."""
