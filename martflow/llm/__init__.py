"""Training-data operators: deduplication, scoring, filtering and tokenisation of documents."""
