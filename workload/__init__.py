"""The registered queries: the library's jobs over the given tables, with their SQL twins."""
