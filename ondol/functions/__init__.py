"""Part of the ondol engine."""
