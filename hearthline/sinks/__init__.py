"""Writing and registering tables."""
