"""Readers, writers, model and run stores."""
