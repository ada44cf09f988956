"""Open-domain question answering over large text collections on Spark."""
