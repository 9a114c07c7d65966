"""Spark-first data preparation: telemetry, logs, Q&A, chats and code files to training tables."""
