"""finlake: layered financial-market analytics (landing, raw, trusted, refined) on PySpark."""
