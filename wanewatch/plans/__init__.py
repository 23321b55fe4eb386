"""Model training, ensembles, search and end-to-end jobs."""
