"""Column helpers of the jobs."""
