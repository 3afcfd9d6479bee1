"""Plans: queries put together from operators."""
