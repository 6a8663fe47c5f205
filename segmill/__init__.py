"""Spark jobs that prepare chat, reasoning and web text for training."""
