"""DataFrame -> DataFrame operators with explicit keys."""
