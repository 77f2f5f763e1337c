"""Reading logs, writing points, and the shared folder for intermediate tables."""
