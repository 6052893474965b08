"""Query catalogue, oracle SQL, and the batch jobs."""
