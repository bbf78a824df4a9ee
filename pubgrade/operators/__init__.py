"""DataFrame-to-DataFrame operators on the entities."""
