"""Caption curation, chat data and training-corpus operators on Spark DataFrames."""
