"""Readers and writers of transactions and alerts."""
