"""Plans: role mappings, train/test jobs, driver queries and their SQL twins."""
