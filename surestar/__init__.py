"""surestar: an insurance star-schema warehouse built from PySpark DataFrame operators."""
