"""Analytics over archives of coded world-news events, on PySpark."""
