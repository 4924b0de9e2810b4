"""Building the stored products."""
