"""Structured Streaming over the landing files, built on the same functions as the batch jobs."""
