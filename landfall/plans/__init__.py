"""Tables of the lake, summaries, answers and the yearly load."""
