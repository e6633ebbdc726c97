"""kithweave: record linkage and training-data preparation as Spark DataFrame transformations."""
