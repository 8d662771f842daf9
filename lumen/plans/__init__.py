"""Role tables derived from the provided data and the registry of named queries."""
