"""Training-data operators for very large text corpora; nothing outside this folder imports them."""
