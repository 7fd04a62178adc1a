"""Topics (directories or Kafka), record formats and settings."""
