"""Analytics over large tables of labelled free-text records, on Spark."""
