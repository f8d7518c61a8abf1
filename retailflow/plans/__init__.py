"""Compositions: the nightly batch and the registered query catalogue."""
