"""Part of the scriptoria engine."""
