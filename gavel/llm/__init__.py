"""Training-data operators: quality, extraction, similarity, removal, scoring, formatting, archiving, packing."""
