"""Where orders are read from and where tables are registered."""
