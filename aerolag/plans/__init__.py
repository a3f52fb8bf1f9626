"""The feature frame and the two jobs built on it."""
