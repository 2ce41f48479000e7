"""Chi-square term scoring, TF-IDF features and linear text classification on Spark."""
