"""Analytics over market ticks, as DataFrame-to-DataFrame functions on Spark."""
