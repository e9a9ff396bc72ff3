"""quarry: a Spark-native engine for curating question-answer records with numeric series."""
