"""vitrine: product-catalogue analytics as PySpark DataFrame plans."""
