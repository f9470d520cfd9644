"""sources of the analytics library."""
