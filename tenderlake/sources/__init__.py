"""Bronze archives, silver tables and serving tables."""
