"""Change-log to profile tables, as DataFrame transformations."""
