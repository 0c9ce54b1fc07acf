"""Reading extracts and reading and writing the store."""
