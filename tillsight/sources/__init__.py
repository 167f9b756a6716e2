"""Input adapters: delimited invoice files and the test-table fixture."""
