"""A Spark-native engine for scholarly knowledge graphs: triples in, triples and reports out."""
