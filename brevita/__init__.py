"""Text-corpus, evaluation and inference-log analytics as Spark DataFrame jobs."""
