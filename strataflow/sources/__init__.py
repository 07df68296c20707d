"""Where data comes in and where tables are kept."""
