"""Table, file and message sources, with the views derived from the given tables."""
