"""Text-corpus analytics and extractive summaries as Spark jobs."""

__version__ = "0.1.0"
