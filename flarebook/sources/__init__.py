"""Where notices come from: Kafka, a replay folder, text documents, a sample."""
