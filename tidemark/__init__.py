"""tidemark: a Spark-native engine for capturing, replaying and verifying tick data."""
