"""Composite jobs, the derived fixture and the registered query set."""
