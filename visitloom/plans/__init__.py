"""The full job and the registered queries."""
