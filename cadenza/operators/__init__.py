"""DataFrame operators on panels."""
