"""Source schemas, extract readers, bronze landing and the test-table fixtures."""
