"""Column -> Column building blocks; nothing here runs a job or needs a global aggregate."""
