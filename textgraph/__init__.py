"""textgraph: long-text analytics on PySpark DataFrames."""
