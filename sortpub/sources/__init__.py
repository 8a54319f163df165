"""Sources and sinks: line files, directory topics, Kafka, the record generator."""
