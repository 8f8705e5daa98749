"""See README.md for what this package holds."""
