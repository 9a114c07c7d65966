"""DataFrame -> DataFrame operators; lazy unless a docstring says that it stages a table."""
