"""Record sources, schemas and the events feed."""
