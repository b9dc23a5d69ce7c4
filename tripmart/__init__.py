"""tripmart: batch analytics for trip-like fact data on Spark DataFrames."""
