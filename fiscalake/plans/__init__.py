"""Plans of the lakehouse."""
