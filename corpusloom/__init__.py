"""corpusloom: a PySpark-native engine for preparing and analysing text and dialogue datasets."""
