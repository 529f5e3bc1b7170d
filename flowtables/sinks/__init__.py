"""Writing tables and files."""
