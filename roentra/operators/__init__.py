"""DataFrame -> DataFrame transforms."""
