"""Column expressions: text cleaning, lexicon features, time parsing, sentiment scores."""
