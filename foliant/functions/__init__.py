"""See the package docstring of ``foliant``."""
