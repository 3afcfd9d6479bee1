"""signalmill: market-signal analytics as DataFrame-to-DataFrame functions on Spark."""
