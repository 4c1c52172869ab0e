"""Sources: driver tables and stand-in views, JDBC reads, saved API pages."""
