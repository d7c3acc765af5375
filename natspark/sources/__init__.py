"""Readers and writers of sessions, packets and batches."""
