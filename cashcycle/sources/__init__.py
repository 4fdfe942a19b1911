"""Reading the mart, watchlists and cached extracts; writing result tables."""
