"""The segment archive as a data source, node clients, and durable sinks."""
