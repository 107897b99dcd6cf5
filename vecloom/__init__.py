"""Text-to-vector feature engine built from PySpark DataFrame operators."""
