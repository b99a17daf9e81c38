"""Training-data operators: cleaning, deduplicating, mixing and encoding a text corpus."""
