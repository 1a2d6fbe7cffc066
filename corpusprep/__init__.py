"""corpusprep: a PySpark-native engine for preparing, searching and evaluating text corpora."""
