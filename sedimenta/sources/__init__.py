"""Reading landed records, and reading and publishing tables."""
