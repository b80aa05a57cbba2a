"""Column expressions: no function here reads data or starts a job."""
