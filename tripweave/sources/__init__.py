"""Readers, landing of daily partitions and stored tables."""
