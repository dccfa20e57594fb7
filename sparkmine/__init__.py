"""sparkmine: survey statistics, rating prediction, frequent itemsets, text
clustering and stream summaries as plain PySpark DataFrame operators."""
