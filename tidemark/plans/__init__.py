"""End-to-end jobs and the catalog of registered queries."""
