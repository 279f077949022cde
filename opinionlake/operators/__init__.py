"""DataFrame -> DataFrame operators; all lazy, columns by name."""
