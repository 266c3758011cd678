"""farelake: batch marts and live counts over taxi trips, as PySpark DataFrame code."""
