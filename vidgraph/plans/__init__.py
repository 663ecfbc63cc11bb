"""Multi-step jobs (import, network run, influence run) and the test fixtures."""
