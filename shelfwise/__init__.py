"""Spark jobs for item catalogs: landing, mapping, merging, price refresh, embeddings and packaging."""
