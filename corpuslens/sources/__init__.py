"""Tables, and readers and writers for files."""
