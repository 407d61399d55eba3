"""Table scans, file drops and the stores of loaded tables."""
