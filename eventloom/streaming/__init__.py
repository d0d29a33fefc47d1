"""Work started by new files."""
