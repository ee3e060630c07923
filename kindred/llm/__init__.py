"""Training-data operators: each stands alone and is imported by nothing else in the library."""
