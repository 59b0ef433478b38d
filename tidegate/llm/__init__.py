"""Training-data operators: detection, scoring, de-duplication, archives and tokenizers on Spark."""
