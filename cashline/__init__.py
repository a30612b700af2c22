"""Order-to-cash analytics on Spark: text extracts in, checked star schema out."""
