"""Pure column expressions; usable in batch and streaming queries alike."""
