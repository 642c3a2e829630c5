"""Reading raw tables and publishing derived ones."""
