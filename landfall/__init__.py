"""landfall: a star schema of traveller arrivals, built and queried with Spark DataFrames."""
