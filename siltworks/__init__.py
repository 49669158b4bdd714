"""A Spark-native engine that turns partitioned logs of semi-structured records into evolving tables."""
