"""tamis: a Spark-native engine for curating balanced, duplicate-free training sets."""
