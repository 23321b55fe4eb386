"""Data quality, features, sampling, evaluation, fallback and monitoring operators."""
