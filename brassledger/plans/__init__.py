"""Plans: one run of the bank pipeline, and the queries over its star schema."""
