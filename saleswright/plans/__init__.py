"""Report registry, staged runs and the star-schema sales table."""
