"""Where tables are kept."""
