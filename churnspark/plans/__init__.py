"""Plans: fixture views over the driver tables and composed jobs."""
