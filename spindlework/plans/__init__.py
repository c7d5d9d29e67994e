"""Job-level pieces: materialised steps and the whole warehouse load."""
